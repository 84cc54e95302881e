"""Latest records, ranks and label resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds _rank within the key and _group_size."""
    w = Window.partitionBy(*keys)
    return rows.withColumn("_rank", F.row_number().over(w.orderBy(*order))).withColumn("_group_size", F.count(F.lit(1)).over(w))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order.  Only one row a key and task is shuffled (the limit is pushed below the exchange)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def older(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows that `latest` leaves out, with a reason to be quarantined."""
    return ranked(rows, keys, order).filter("_rank > 1").withColumn(
        "quarantine_reason",
        F.lit("duplicate_business_key_non_latest"),
    ).drop("_rank", "_group_size")


def newest_by(*columns: str, then: tuple[str, ...] = ()) -> list[Column]:
    """Newest first, nulls last; ties by further columns, largest first."""
    return [F.col(c).desc_nulls_last() for c in (*columns, *then)]


def resolve_labels(labels: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One final label a transaction: of those that are known and final the newest by label, ingestion and source time, then event id."""
    from sluice.functions.predicates import supervised

    final = labels.filter(supervised(F.col("is_fraud"), F.col("investigation_status")))
    return latest(final, [key], newest_by("label_timestamp", "ingestion_timestamp", "source_timestamp", then=("event_id",)))


def label_multiplicity(labels: DataFrame, key: str) -> DataFrame:
    """Most labels of a transaction (1 if there are none) and how many transactions have several."""
    counts = labels.groupBy(key).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.max("_n"), F.lit(1)).cast("long").alias("most_labels"), F.count(F.when(F.col("_n") > 1, 1)).alias("with_several"))


def merge_training_rows(history: DataFrame, live: DataFrame, key: str, order: list[str]) -> DataFrame:
    """History and live rows, one a transaction: live before history, then newest by `order`."""
    rows = history.withColumn("_live", F.lit(0)).unionByName(live.withColumn("_live", F.lit(1)), allowMissingColumns=True)
    return latest(rows, [key], [F.col("_live").desc(), *newest_by(*order)]).withColumn(
        "source",
        F.when(F.col("_live") == 1, "live").otherwise("history"),
    ).drop("_live")
