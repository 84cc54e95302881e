"""Reporting tables: decisions with feedback, KPIs, hourly series, segments, bands, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.typing import hour_of
from sluice.operators.metrics import ratio

#: Upper ends of probability bands.
BANDS = ((0.01, "below_1_percent"), (0.05, "1_to_5_percent"), (0.20, "5_to_20_percent"), (0.80, "20_to_80_percent"))


def outcome(label: Column, predicted: Column) -> Column:
    """TP, FP, FN or TN; rows with nulls must be filtered before: they would count as TN."""
    return F.when(label & predicted, "TP").when(~label & predicted, "FP").when(label & ~predicted, "FN").otherwise("TN")


def feedback(decisions: DataFrame, labels: DataFrame, key: str, decided: str, labelled: str) -> DataFrame:
    """Decisions with their labels, the outcome, the label's delay in seconds and whether it came after the decision.

    decisions: key, predicted, score, decided; labels: key, is_fraud, labelled.
    """
    d = decisions.filter(F.col("predicted").isNotNull())
    joined = d.join(labels.filter(F.col("is_fraud").isNotNull()), key)
    delay = F.unix_seconds(F.col(labelled).cast("timestamp")) - F.unix_seconds(F.col(decided).cast("timestamp"))
    return joined.select(
        "*",
        outcome(F.col("is_fraud"), F.col("predicted")).alias("outcome"),
        delay.alias("label_delay_seconds"),
        (F.col(labelled) > F.col(decided)).alias("label_after_decision"),
    )


def gold_decisions(transactions: DataFrame, decisions: DataFrame, feedback_rows: DataFrame, key: str) -> DataFrame:
    """All transactions with their decision and feedback where there is one."""
    return transactions.join(decisions, key, "left").join(feedback_rows.select(key, "is_fraud", "outcome"), key, "left")


def kpi_row(gold: DataFrame, amount: str = "amount") -> DataFrame:
    """One row of counts, values and rates; rates are null where undefined."""
    n = lambda c: F.count(F.when(c, 1))
    fraud, predicted, out = F.col("is_fraud"), F.col("predicted"), F.col("outcome")
    sums = gold.agg(
        F.count("*").alias("transactions"),
        n(F.col("score").isNotNull()).alias("scored"),
        n(fraud.isNotNull()).alias("labelled"),
        n(fraud).alias("frauds"),
        n(predicted).alias("predicted_frauds"),
        *(n(out == x).alias(x.lower()) for x in ("TP", "FP", "TN", "FN")),
        F.sum(amount).alias("volume"),
        F.sum(F.when(fraud, F.col(amount))).alias("fraud_volume"),
        F.avg("score").alias("average_score"),
        F.max("score").alias("highest_score"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        "*",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(F.col("frauds"), F.col("labelled")).alias("fraud_rate"),
    )


def hourly_series(gold: DataFrame, ts: str, amount: str = "amount") -> DataFrame:
    """Counts, volumes and scores of each hour."""
    n = lambda c: F.count(F.when(c, 1))
    return gold.groupBy(hour_of(F.col(ts)).alias("hour")).agg(
        F.count("*").alias("transactions"),
        F.sum(amount).alias("volume"),
        n(F.col("score").isNotNull()).alias("scored"),
        n(F.col("is_fraud")).alias("frauds"),
        n(F.col("predicted")).alias("predicted_frauds"),
        F.avg("score").alias("average_score"),
        F.max("score").alias("highest_score"),
        F.sum(F.when(F.col("is_fraud"), F.col(amount)).otherwise(0.0)).alias("fraud_volume"),
    )


def by_segment(gold: DataFrame, segment: str, amount: str = "amount") -> DataFrame:
    """Activity of each value of a column."""
    n = lambda c: F.count(F.when(c, 1))
    return gold.groupBy(segment).agg(
        F.count("*").alias("transactions"),
        F.sum(amount).alias("volume"),
        n(F.col("is_fraud")).alias("frauds"),
        n(F.col("predicted")).alias("predicted_frauds"),
        F.avg("score").alias("average_score"),
    )


def probability_band(score: Column) -> Column:
    """The band of a score; unscored for null."""
    out = F.when(score.isNull(), "unscored")
    for below, name in BANDS:
        out = out.when(score < below, name)
    return out.otherwise("80_percent_and_more")


def by_band(gold: DataFrame) -> DataFrame:
    """Rows and frauds of each band."""
    return gold.groupBy(probability_band(F.col("score")).alias("band")).agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("is_fraud"), 1)).alias("frauds"),
    )


def confusion_counts(gold: DataFrame) -> DataFrame:
    """Rows of each outcome, rows without one left out."""
    return gold.filter("outcome IS NOT NULL").groupBy("outcome").agg(F.count("*").alias("n"))


def top_risks(gold: DataFrame, key: str, n: int = 100, *then: str) -> DataFrame:
    """The n highest scores; ties by further columns, newest first, and then by key."""
    return gold.filter("score IS NOT NULL").orderBy(F.col("score").desc(), *(F.col(c).desc() for c in then), key).limit(n)


def reconciliation(
    transactions: DataFrame,
    decisions: DataFrame,
    feedback_rows: DataFrame,
    gold: DataFrame,
    kpi: DataFrame,
    key: str,
    amount: str = "amount",
) -> DataFrame:
    """Seven checks between sources, the gold table and its KPI row, as rows of name, expected, found and status; each frame is read once."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    wrong = F.col("score").isNotNull() & ((F.col("score") < 0) | (F.col("score") > 1))
    of_gold = gold.agg(
        F.count("*").alias("_gold"),
        F.count_distinct(key).alias("_keys"),
        F.count(F.when(wrong, 1)).alias("_wrong"),
        F.count(F.when(F.col(amount).isNull(), 1)).alias("_null"),
    )
    one = of_gold
    for other in (
        n(transactions, "_tx"),
        n(decisions, "_dec"),
        n(feedback_rows, "_fb"),
        kpi.select(F.col("transactions").alias("_all"), F.col("scored").alias("_scored"), F.col("labelled").alias("_labelled")),
    ):
        one = one.crossJoin(other)  # one row each
    zero = F.lit(0).cast("long")
    checks = (
        ("gold_transaction_rows_match_source_transactions", F.col("_tx"), F.col("_gold")),
        ("gold_transaction_ids_unique", zero, F.col("_gold") - F.col("_keys")),
        ("kpi_total_transactions_match_gold", F.col("_gold"), F.col("_all")),
        ("kpi_scored_transactions_match_decisions", F.col("_dec"), F.col("_scored")),
        ("kpi_labeled_transactions_match_feedback", F.col("_fb"), F.col("_labelled")),
        ("fraud_probabilities_in_unit_interval", zero, F.col("_wrong")),
        ("transaction_amounts_numeric_and_present", zero, F.col("_null")),
    )
    rows = one.select(F.explode(F.array(*(F.struct(
        F.lit(name).alias("check_name"),
        a.alias("expected"),
        b.alias("found"),
    ) for name, a, b in checks))).alias("_c")).select("_c.*")
    return rows.withColumn("status", F.when(F.col("expected") == F.col("found"), "PASS").otherwise("FAIL"))


#: Views over the gold table, as Spark SQL; {gold} is its name.
VIEWS = {
    **{
        f"fraud_activity_by_{c}": f"SELECT {c}, count(*) AS transactions, sum(amount) AS volume, count_if(is_fraud) AS frauds, count_if(predicted) AS predicted_frauds, avg(score) AS average_score, max(score) AS highest_score FROM {{gold}} GROUP BY {c}"
        for c in ("segment", "country", "transaction_type")
    },
    "fraud_outcomes": "SELECT outcome, count(*) AS n FROM {gold} WHERE outcome IS NOT NULL GROUP BY outcome",
    "fraud_score_bands": "SELECT CASE WHEN score IS NULL THEN 'unscored' WHEN score < 0.01 THEN 'below_1_percent' WHEN score < 0.05 THEN '1_to_5_percent' WHEN score < 0.20 THEN '5_to_20_percent' WHEN score < 0.80 THEN '20_to_80_percent' ELSE '80_percent_and_more' END AS band, count(*) AS n FROM {gold} GROUP BY 1",
}


def create_views(gold: DataFrame, name: str = "gold_rows") -> list[str]:
    """Registers the gold rows and the views over them that their columns allow; gives the views' names."""
    gold.createOrReplaceTempView(name)
    own = {v: t for v, t in VIEWS.items() if (c := v.removeprefix("fraud_activity_by_")) == v or c in gold.columns}
    for view, text in own.items():
        gold.sparkSession.sql(text.format(gold=name)).createOrReplaceTempView(view)
    return list(own)
