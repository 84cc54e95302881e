"""Writes: overwrite, create, keyed upserts, insert-only, partitioned and single files, and the run log."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_table(rows: DataFrame, name: str) -> None:
    """Replaces a table, schema included."""
    rows.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def create_if_missing(rows: DataFrame, name: str) -> bool:
    """Creates an empty table with the rows' schema unless it is there."""
    if rows.sparkSession.catalog.tableExists(name):
        return False
    rows.limit(0).write.saveAsTable(name)
    return True


def replace_folder(spark: SparkSession, made: str, path: str) -> None:
    """Puts a finished folder in the place of another: the old one is moved aside, not deleted, until the new one stands."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    system = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    had = system.exists(at(path))
    if had and not system.rename(at(path), at(old)):
        raise OSError(f"{path} could not be moved")
    if not system.rename(at(made), at(path)):
        if had:
            system.rename(at(old), at(path))
        raise OSError(f"{path} could not be replaced")
    if had:
        system.delete(at(old), True)


def write_partitioned(rows: DataFrame, path: str, *by: str) -> None:
    """Parquet in key=value folders, written beside the target and moved there when it is whole: a write that fails leaves the old rows."""
    made = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    writer = rows.write.partitionBy(*by) if by else rows.write
    writer.parquet(made)
    replace_folder(rows.sparkSession, made, path)


def write_single(rows: DataFrame, path: str) -> None:
    """Parquet in one file, moved to its place when it is whole: for results that are small by nature."""
    write_partitioned(rows.coalesce(1), path)


def exact_decimals(rows: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    """Columns rounded half up to decimals of fixed digits."""
    return rows.withColumns({c: F.round(F.col(c), digits).cast(f"decimal(20,{digits})") for c in columns})


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of all keys of two aliased sides."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """The target after a merge, with `_action`: insert, update (only where the digest differs), unchanged or keep.

    One full outer join on the keys, nulls equal; the source must have a key once.
    """
    mine = F.col("t._there").isNotNull()
    theirs = F.col("s._there").isNotNull()
    new = F.col(f"t.{digest}").eqNullSafe(F.col(f"s.{digest}"))
    action = F.when(~mine, "insert").when(~theirs, "keep").when(new, "unchanged").otherwise("update")
    joined = target.withColumn("_there", F.lit(1)).alias("t").join(source.withColumn("_there", F.lit(1)).alias("s"), same_key("t", "s", keys), "full")
    use = action.isin("insert", "update")
    return joined.select(*(F.when(use, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns), action.alias("_action"))


def upsert_counts(merged: DataFrame) -> DataFrame:
    """How many rows each action has."""
    return merged.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n"))


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose keys the target lacks, nulls equal, one row a key."""
    return source.alias("s").join(target.alias("t"), same_key("s", "t", keys), "left_anti").dropDuplicates(keys)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target and the source's new rows behind it."""
    return target.unionByName(new_rows(source, target, keys).select(*target.columns))


def changed_rows(source: DataFrame, target: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Source rows whose key is in the target with another digest."""
    return source.alias("s").join(
        target.alias("t"),
        same_key("s", "t", keys),
        "inner",
    ).filter(~F.col(f"s.{digest}").eqNullSafe(F.col(f"t.{digest}"))).select("s.*")


def logged(rows: DataFrame, path: str, log: str, run_id: str, table: str, write=write_partitioned) -> int:
    """Writes rows by a sink and adds their number to the run log."""
    write(rows, path)
    n = rows.sparkSession.read.parquet(path).count()
    log_run(rows.sparkSession, log, run_id, table, n, "write")
    return n


def manifest(spark: SparkSession, tables: dict[str, str], run_id: str, version: str) -> DataFrame:
    """A row a table (name: path) of a run: path, rows, files, bytes and partition columns."""
    from sluice.sources.tables import inspect_layout

    rows = []
    for name, path in tables.items():
        layout = inspect_layout(spark, path)
        rows.append((run_id, version, name, path, spark.read.parquet(path).count(), layout.files, layout.bytes, ",".join(layout.partitions)))
    return spark.createDataFrame(
        rows,
        "run_id string, version string, table_name string, path string, n_rows long, files int, bytes long, partitions string",
    )


def freshness(spark: SparkSession, log: str, now: Column | None = None) -> DataFrame:
    """Seconds since the newest log row of each table."""
    at = F.current_timestamp() if now is None else now
    newest = spark.read.parquet(log).groupBy("table_name").agg(F.max("logged_at").alias("_at"))
    return newest.select("table_name", (F.unix_seconds(at.cast("timestamp")) - F.unix_seconds("_at")).alias("age_seconds"))


def log_run(spark: SparkSession, path: str, run_id: str, table: str, rows: int, operation: str) -> None:
    """Adds a row to the run log, which stands for a table's history."""
    spark.createDataFrame(
        [(run_id, table, rows, operation)],
        "run_id string, table_name string, n_rows long, operation string",
    ).withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """The newest log row of each table."""
    return spark.read.parquet(path).groupBy("table_name").agg(F.max_by(F.struct("run_id", "n_rows", "operation", "logged_at"), "logged_at").alias("_last")).select(
        "table_name",
        "_last.*",
    )


def row_deltas(spark: SparkSession, path: str) -> DataFrame:
    """Newest minus oldest row count of each logged table."""
    log = spark.read.parquet(path)
    return log.groupBy("table_name").agg((F.max_by("n_rows", "logged_at") - F.min_by("n_rows", "logged_at")).alias("delta"))
