"""Chronological splits: fixed shares, rare events, integrity, digests, samples.

Positions in time come from counts of parts of the time range, so no task sorts all rows: a row's position is its rank in
its part plus the rows of the parts before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positioned(rows: DataFrame, ts: str, tie: str) -> DataFrame:
    """Adds _position from 1 in order of (ts, tie), and _total."""
    part = rows.withColumn("_part", F.to_date(F.col(ts)))
    counts = part.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a day
    before = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy(F.col("_part").asc_nulls_first())) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(ts, tie))
    ranked = part.withColumn("_rank", rank)
    return ranked.join(F.broadcast(before), ranked["_part"].eqNullSafe(before["_part"])).select(
        *rows.columns,
        (F.col("_rank") + F.col("_before")).alias("_position"),
        "_total",
    )


def chronological_split(rows: DataFrame, ts: str, tie: str, train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """Adds split: the first share of rows is train, the next validation, the rest test."""
    p = positioned(rows, ts, tie)
    first = F.floor(F.col("_total") * F.lit(train).cast("decimal(5,4)"))
    second = F.floor(F.col("_total") * (F.lit(train).cast("decimal(5,4)") + F.lit(validation).cast("decimal(5,4)")))
    return p.withColumn(
        "split",
        F.when(F.col("_position") <= first, "train").when(F.col("_position") <= second, "validation").otherwise("test"),
    ).drop("_position", "_total")


def rare_event_bounds(
    rows: DataFrame,
    ts: str,
    tie: str,
    label: str,
    least: tuple[float, float, float] = (0.60, 0.10, 0.10),
    events: int = 3,
    wanted: tuple[float, float] = (0.70, 0.15),
) -> DataFrame:
    """train_end and validation_end (positions) of the rare-event split; no row if no split has enough events.

    The test part starts as late as it can with `events` events in it and in a validation part before it and at least
    the least shares of rows; then the validation part starts where the shares are nearest the wanted ones (sum of
    absolute differences; ties: the earlier end of train).  The latest start follows from the last events,
    and train_end is then a bound of its range or beside a corner of the distance, so there are six candidates however
    many rows there are.
    """
    p = positioned(rows.withColumn("_y", F.col(label).cast("int")), ts, tie)
    events_at = p.filter("_y = 1").select("_position")
    total = p.agg(F.max("_total").alias("_total"))
    ranked = events_at.orderBy(F.col("_position").desc()).limit(events).agg(F.min("_position").alias("_test_event"), F.count("*").alias("_late"))
    one = total.crossJoin(ranked)  # one row each
    share = lambda x: F.ceil(F.col("_total") * F.lit(x).cast("decimal(5,4)"))
    end = one.filter(F.col("_late") == events).select(
        "_total",
        F.least(F.col("_test_event") - 1, F.col("_total") - share(least[2])).alias("validation_end"),
    )
    valid = events_at.crossJoin(F.broadcast(end)).filter("_position <= validation_end")  # one row of bounds
    third = valid.orderBy(F.col("_position").desc()).limit(events).agg(F.min("_position").alias("_valid_event"), F.count("*").alias("_found"))
    bounds = end.crossJoin(third).filter(F.col("_found") == events)
    high = F.least(F.col("_valid_event") - 1, F.col("validation_end") - share(least[1]))
    low = share(least[0])
    n = F.col("_total").cast("double")
    # the sum of distances falls, is flat between two corners, and rises: the best end is a bound or beside a corner
    corners = [low, high, *(f(x) for x in (n * wanted[0], F.col("validation_end") - n * wanted[1]) for f in (F.floor, F.ceil))]
    grid = bounds.filter(high >= low).select(
        "_total",
        "validation_end",
        F.explode(F.array(*(F.least(F.greatest(x, low), high).cast("long") for x in corners))).alias("train_end"),
    )
    distance = F.abs(F.col("train_end") / n - wanted[0]) + F.abs((F.col("validation_end") - F.col("train_end")) / n - wanted[1]) + F.abs((F.col("_total") - F.col("validation_end")) / n - (1 - wanted[0] - wanted[1]))
    return grid.select(
        F.col("train_end").cast("long").alias("train_end"),
        F.col("validation_end").cast("long").alias("validation_end"),
        F.round(distance, 9).alias("distance"),
    ).orderBy("distance", "train_end").limit(1)


def split_stats(rows: DataFrame, ts: str, label: str, *entities: str) -> DataFrame:
    """Rows, events, event rate, time bounds and distinct entities of each split."""
    y = F.col(label).cast("int")
    return rows.groupBy("split").agg(
        F.count("*").alias("n"),
        F.sum(y).cast("long").alias("events"),
        F.avg(y).alias("event_rate"),
        F.min(ts).alias("first_at"),
        F.max(ts).alias("last_at"),
        *(F.count_distinct(e).alias(f"distinct_{e}") for e in entities),
    )


def split_integrity(rows: DataFrame, key: str, ts: str, label: str) -> DataFrame:
    """Checks of a split: no key in two parts, all rows in one, parts in order of time, both classes everywhere."""
    overlap = rows.groupBy(key).agg(F.count_distinct("split").alias("_n")).filter("_n > 1").agg(F.count("*").alias("n")).select(
        F.lit("overlap").alias("check_name"),
        "n",
    )
    uncovered = rows.filter(F.col("split").isNull()).agg(F.count("*").alias("n")).select(F.lit("uncovered").alias("check_name"), "n")
    at = lambda f, s: f(F.when(F.col("split") == s, F.col(ts)))
    order = rows.agg(((at(F.max, "train") > at(F.min, "validation")).cast("int") + (at(F.max, "validation") > at(F.min, "test")).cast("int")).cast("long").alias("n")).select(
        F.lit("out_of_order").alias("check_name"),
        "n",
    )
    classes = rows.groupBy("split").agg(F.count_distinct(label).alias("_n")).filter("_n < 2").agg(F.count("*").alias("n")).select(
        F.lit("one_class").alias("check_name"),
        "n",
    )
    return overlap.unionByName(uncovered).unionByName(order).unionByName(classes)


def split_lines(key: str, version: str, feature_version: str) -> Column:
    """id|split|feature version|version."""
    return F.concat_ws("|", F.col(key).cast("string"), "split", F.lit(feature_version), F.lit(version))


def split_digest(rows: DataFrame, key: str, version: str, feature_version: str = "v1") -> DataFrame:
    """SHA-256 of all lines id|split|feature version|version in order of id, joined by line ends.

    One digest over all lines is one chain: the sort is distributed, then one task reads its parts one after another,
    a batch at a time.  For splits too long for that there is `split_digest_tree`.
    """

    def chain(batches):
        import hashlib

        import pyarrow as pa

        digest, any_ = hashlib.sha256(), False
        for batch in batches:
            for line in batch.column(0).to_pylist():
                digest.update((b"\n" if any_ else b"") + line.encode())
                any_ = True
        yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()])], names=["split_digest"])

    lines = rows.select(F.col(key).alias("_key"), split_lines(key, version, feature_version).alias("_line")).orderBy("_key").select("_line")
    return lines.coalesce(1).mapInArrow(chain, "split_digest string")


def split_digest_tree(rows: DataFrame, key: str, version: str, feature_version: str = "v1", part: Column | None = None) -> DataFrame:
    """SHA-256 of the sorted lines id|split|feature version|version of each part of the keys, and of the parts' digests.

    A digest of digests: no task gathers all lines.  part: of a key, by default one of 256 by its crc32.
    """
    line = split_lines(key, version, feature_version)
    part = F.pmod(F.crc32(F.col(key).cast("string")), F.lit(256)) if part is None else part
    own = rows.groupBy(part.alias("_part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("_d"))
    return own.agg(F.sha2(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_d"))), lambda x: x["_d"]), "\n"),
        256,
    ).alias("split_digest"))


def stratified_ids(rows: DataFrame, key: str, strata: list[tuple[str, Column, int]], most: int = 100) -> DataFrame:
    """The first ids of each stratum by id, once each, with their strata; at most `most` of them."""
    taken = None
    for name, condition, n in strata:
        own = rows.filter(condition).select(key).distinct().orderBy(key).limit(n).withColumn("_s", F.lit(name))
        taken = own if taken is None else taken.unionByName(own)
    return taken.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("_s")), ",").alias("strata")).orderBy(key).limit(most)


def retrain_allowed(live: DataFrame, combined: DataFrame, label: str) -> DataFrame:
    """Whether there are live rows and both classes among live and among all rows."""
    a = live.agg(F.count("*").alias("live_rows"), F.count_distinct(label).alias("_l"))
    b = combined.agg(F.count_distinct(label).alias("_c"))
    return a.crossJoin(b).select("live_rows", ((F.col("live_rows") > 0) & (F.col("_l") == 2) & (F.col("_c") == 2)).alias("allowed"))  # one row each
