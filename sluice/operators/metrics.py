"""Counts, profiles, classification metrics and threshold choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def profile_numeric(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A row a column: nulls, zeros, negatives, NaNs, infinities, minimum, maximum, mean, sample deviation; one aggregate over all of them."""
    stats = []
    for c in columns:
        d = F.col(c).cast("double")
        finite = F.when(~(F.isnan(d) | (F.abs(d) == float("inf"))), d)
        stats.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.when(d.isNull(), 1)).alias("nulls"),
            F.count(F.when(d == 0, 1)).alias("zeros"),
            F.count(F.when(d < 0, 1)).alias("negatives"),
            F.count(F.when(F.isnan(d), 1)).alias("nans"),
            F.count(F.when(F.abs(d) == float("inf"), 1)).alias("infinities"),
            F.min(finite).alias("minimum"),
            F.max(finite).alias("maximum"),
            F.avg(finite).alias("mean"),
            F.stddev_samp(finite).alias("deviation"),
        ))
    return rows.agg(F.array(*stats).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")


def profile_categorical(rows: DataFrame, columns: list[str]) -> DataFrame:
    """How often each value of each column comes, and its place: most frequent first, then by value, nulls last; one pass for all columns."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = rows.select(pairs.alias("_p")).groupBy("_p.column_name", "_p.value").agg(F.count("*").alias("n"))
    line = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    return counts.withColumn("place", F.row_number().over(line))


def confusion(label: Column, predicted: Column) -> dict[str, Column]:
    """Counts of the four outcomes."""
    n = lambda c: F.count(F.when(c, 1))
    return {"tp": n(label & predicted), "fp": n(~label & predicted), "tn": n(~label & ~predicted), "fn": n(label & ~predicted)}


def with_rates(counts: DataFrame) -> DataFrame:
    """Adds precision, recall, F1, specificity, false rates and balanced accuracy; null where undefined."""
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    recall, spec = ratio(tp, tp + fn), ratio(tn, tn + fp)
    return counts.select(
        "*",
        ratio(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        spec.alias("specificity"),
        ratio(fp, fp + tn).alias("false_positive_rate"),
        ratio(fn, fn + tp).alias("false_negative_rate"),
        ((recall + spec) / 2).alias("balanced_accuracy"),
    )


def classification_metrics(rows: DataFrame, label: Column, predicted: Column, by: list[str] | None = None) -> DataFrame:
    """Outcome counts and rates, for all rows or each segment."""
    aggs = [c.alias(k) for k, c in confusion(label, predicted).items()]
    return with_rates(rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs))


#: Parts that distinct scores are summed in.
PARTS = 256


def _ordered_sums(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives and rows, and their sums from the highest score down.

    Equal scores are one row first, and running sums are over PARTS parts between quantiles of the scores with each
    part's total added, so no task sees all scores, wherever they crowd.
    """
    own = rows.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.sum(label).alias("p"),
        F.count("*").alias("n"),
    )
    ends = own.agg(F.percentile_approx("s", [i / PARTS for i in range(1, PARTS)]).alias("_ends"))  # one row
    part = own.crossJoin(F.broadcast(ends)).withColumn("_part", F.expr("size(filter(_ends, e -> e < s))")).drop("_ends")
    totals = part.groupBy("_part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    above = Window.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)  # over the parts' totals only
    before = totals.select(
        "_part",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p0"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0"),
    )
    line = Window.partitionBy("_part").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return part.join(F.broadcast(before), "_part").select(
        "s",
        "p",
        "n",
        (F.sum("p").over(line) + F.col("_p0")).alias("cum_p"),
        (F.sum("n").over(line) + F.col("_n0")).alias("cum_n"),
    )


def average_precision(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Sum over distinct scores of precision times the step in recall; null unless both classes are there."""
    sums = _ordered_sums(rows, label, score)
    out = sums.agg(F.sum(F.col("p") * F.col("cum_p") / F.col("cum_n")).alias("_a"), F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    return out.select(F.when((F.col("_p") > 0) & (F.col("_p") < F.col("_n")), F.col("_a") / F.col("_p")).alias("average_precision"))


def roc_auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Share of positive-negative pairs in the right order, ties half; null unless both classes are there."""
    sums = _ordered_sums(rows, label, score)
    negatives_below = F.col("_all_n") - F.col("_all_p") - (F.col("cum_n") - F.col("cum_p"))
    totals = sums.agg(F.sum("p").alias("_all_p"), F.sum("n").alias("_all_n"))
    each = sums.crossJoin(F.broadcast(totals))  # one row of totals
    out = each.agg(
        F.sum(F.col("p") * (negatives_below + (F.col("n") - F.col("p")) / 2)).alias("_u"),
        F.max("_all_p").alias("_p"),
        F.max("_all_n").alias("_n"),
    )
    return out.select(F.when(
        (F.col("_p") > 0) & (F.col("_p") < F.col("_n")),
        F.col("_u") / (F.col("_p") * (F.col("_n") - F.col("_p"))),
    ).alias("roc_auc"))


#: Fixed grid of decision thresholds.
THRESHOLDS = (0.30, 0.40, 0.50, 0.60, 0.70, 0.80)


def threshold_sweep(rows: DataFrame, label: Column, score: Column, grid: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Outcome counts and rates at each threshold: one aggregate over the rows, then a row a threshold."""
    cells = F.array(*(F.struct(F.lit(t).alias("threshold"), *(c.alias(k) for k, c in confusion(label, score >= t).items())) for t in grid))
    return with_rates(rows.agg(cells.alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*"))


def chosen_threshold(sweep: DataFrame, least_recall: float = 4 / 6) -> DataFrame:
    """Among thresholds with enough recall: fewest false positives, then highest precision, then highest threshold; if none has enough, highest recall first."""
    enough = F.coalesce(F.col("recall") >= least_recall, F.lit(False))
    return sweep.orderBy(
        enough.desc(),
        F.when(~enough, F.col("recall")).desc_nulls_last(),
        F.col("fp"),
        F.col("precision").desc_nulls_last(),
        F.col("threshold").desc(),
    ).limit(1)


def chosen_model(candidates: DataFrame, least_recall: float) -> DataFrame:
    """Among candidates (name, recall, fp, pr_auc, precision): enough recall, then fewest false positives, highest PR-AUC and precision."""
    return candidates.filter(F.col("recall") >= least_recall).orderBy(
        "fp",
        F.col("pr_auc").desc_nulls_last(),
        F.col("precision").desc_nulls_last(),
        "name",
    ).limit(1)


def parity(left: DataFrame, right: DataFrame, key: str, columns: list[str], absolute: float = 1e-6, relative: float = 1e-9) -> DataFrame:
    """For each column of two frames: rows that are exact, within tolerance, different and on one side only, the largest difference, and a status.

    The frames are joined once, as wide rows; keys that one side lacks are mismatches.
    """
    side = lambda df, name: df.select(
        F.col(key).alias(f"_key{name}"),
        F.lit(True).alias(f"_in{name}"),
        *(F.col(c).cast("double").alias(f"{name}_{c}") for c in columns),
    )
    wide = side(left, "_a").join(side(right, "_b"), F.col("_key_a") == F.col("_key_b"), "full")
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"_a_{c}").alias("_a"), F.col(f"_b_{c}").alias("_b")) for c in columns))
    rows = wide.select("_in_a", "_in_b", F.explode(cells).alias("_f")).select("_in_a", "_in_b", "_f.*")
    a, b = F.col("_a"), F.col("_b")
    single = F.col("_in_a").isNull() | F.col("_in_b").isNull()
    both_null, one_null = a.isNull() & b.isNull(), a.isNull() != b.isNull()
    diff = F.abs(a - b)
    exact = ~single & (both_null | F.coalesce(a == b, F.lit(False)))
    close = ~exact & F.coalesce((diff <= absolute) | (diff <= relative * F.greatest(F.abs(a), F.abs(b))), F.lit(False))
    n = lambda c: F.count(F.when(c, 1))
    out = rows.groupBy("feature").agg(
        n(exact).alias("exact"),
        n(close).alias("tolerance"),
        n(~exact & ~close | one_null).alias("mismatch"),
        n(F.col("_in_b").isNull()).alias("left_only"),
        n(F.col("_in_a").isNull()).alias("right_only"),
        F.coalesce(F.max(diff), F.lit(0.0)).alias("largest_difference"),
    )
    return out.withColumn("status", F.when(F.col("mismatch") > 0, "MISMATCH").when(F.col("tolerance") > 0, "TOLERANCE").otherwise("EXACT"))


def parity_families(found: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """For every feature of every family: MATCH, MAJOR-MISMATCH or, where parity knows nothing of it, NOT-VERIFIABLE."""
    spark = found.sparkSession
    every = spark.createDataFrame([(f, c) for f, cs in families.items() for c in cs], "family string, feature string")
    status = F.when(
        F.col("status").isin("EXACT", "TOLERANCE"),
        "MATCH",
    ).when(F.col("status") == "MISMATCH", "MAJOR-MISMATCH").otherwise("NOT-VERIFIABLE")
    return every.join(found.select("feature", "status"), "feature", "left").select("feature", "family", status.alias("static_status"))


def segment_metrics(rows: DataFrame, segments: dict[str, Column], label: Column, predicted: Column, score: Column) -> DataFrame:
    """For each value of each segment: rows, events, mean score, flagged rows, precision and recall (null where undefined); one pass for all segments."""
    pairs = F.explode(F.array(*(F.struct(
        F.lit(n).alias("segment_name"),
        F.coalesce(c.cast("string"), F.lit("__MISSING__")).alias("segment_value"),
    ) for n, c in segments.items())))
    cells = rows.select(pairs.alias("_s"), label.alias("_y"), predicted.alias("_p"), score.alias("_score"))
    n = lambda c: F.count(F.when(c, 1))
    y, p = F.col("_y"), F.col("_p")
    out = cells.groupBy("_s.segment_name", "_s.segment_value").agg(
        F.count("*").alias("row_count"),
        n(y).alias("fraud_count"),
        F.avg("_score").alias("average_probability"),
        n(p).alias("high_risk_count"),
        n(y & p).alias("_tp"),
    )
    return out.withColumns({
        "fraud_precision": ratio(F.col("_tp"), F.col("high_risk_count")),
        "fraud_recall": ratio(F.col("_tp"), F.col("fraud_count")),
    }).drop("_tp")


def cold_start(previous: Column) -> Column:
    """cold_start for rows without any earlier event, existing_history for others."""
    return F.when(F.coalesce(previous.cast("double"), F.lit(0.0)) == 0, "cold_start").otherwise("existing_history")


def fraud_distribution(transactions: DataFrame, labels: DataFrame, audit: DataFrame, key: str) -> DataFrame:
    """Confirmed frauds, their share of all and of completed transactions, whether it is in the approved range, and labelled rows of each scenario, as name and value."""
    paid = transactions.agg(F.count("*").alias("transactions"), F.count(F.when(F.col("transaction_status") == "COMPLETED", 1)).alias("completed"))
    one = paid.crossJoin(labels.agg(F.count(F.when(F.col("is_fraud"), 1)).alias("frauds")))  # one row each
    rate = F.coalesce(ratio(F.col("frauds"), F.col("transactions")), F.lit(0.0))
    values = {
        "confirmed_fraud_count": F.col("frauds"),
        "transaction_count": F.col("transactions"),
        "completed_transaction_count": F.col("completed"),
        "fraud_rate": rate,
        "completed_transaction_fraud_rate": F.coalesce(ratio(F.col("frauds"), F.col("completed")), F.lit(0.0)),
        "fraud_rate_within_approved_range": rate.between(0.005, 0.01).cast("int"),
    }
    totals = one.select(F.explode(F.array(*(F.struct(
        F.lit(k).alias("name"),
        v.cast("double").alias("value"),
    ) for k, v in values.items()))).alias("_v")).select("_v.*")
    scenarios = audit.filter("label_expected").groupBy(F.concat(
        F.lit("scenario:"),
        "scenario_id",
    ).alias("name")).agg(F.count(key).cast("double").alias("value"))
    return totals.unionByName(scenarios)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All frames' rows, by column name."""
    return reduce(DataFrame.unionByName, frames)
