"""Scans, file layouts and ingestion metadata."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a directory of Parquet tables; its schema is the files' own."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, base_path: str | None = None) -> DataFrame:
    """A Parquet scan with a given or the files' schema; key=value folders below base_path become columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return (reader.option("basePath", base_path) if base_path else reader).parquet(path)


@dataclass
class Layout:
    """What lies below a path: files, their bytes, and the partition columns of their folders in order."""

    path: str
    files: int = 0
    bytes: int = 0
    partitions: list[str] = field(default_factory=list)


def inspect_layout(spark: SparkSession, path: str, suffix: str = ".parquet") -> Layout:
    """Lists a path of any file system that Spark reads, recursively."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = Layout(path)
    if not system.exists(root):
        return out
    files = system.listFiles(root, True)
    while files.hasNext():
        status = files.next()
        where = status.getPath().toString()
        if where.endswith(suffix):
            out.files += 1
            out.bytes += status.getLen()
            for part in where[len(root.toString()) :].split("/")[:-1]:
                if "=" in part and (name := part.split("=", 1)[0]) not in out.partitions:
                    out.partitions.append(name)
    return out


def with_ingestion_metadata(rows: DataFrame, run_id: str) -> DataFrame:
    """Adds when, from which file (and its time) and in which run a row was read."""
    return rows.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
        F.lit(run_id).alias("_run_id"),
    )


def conform(rows: DataFrame, schema: T.StructType, rescued: str = "_rescued") -> DataFrame:
    """Rows in a schema; values that a cast loses and columns it does not name go, as JSON, to the rescued column."""
    have = {f.name: f.dataType for f in rows.schema}
    columns, lost = [], []
    for f in schema:
        if f.name not in have:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{f.name}`")
        typed = value.try_cast(f.dataType)
        columns.append(typed.alias(f.name))
        lost.append(F.when(value.isNotNull() & typed.isNull(), value.cast("string")).alias(f.name))
    lost += [F.col(f"`{c}`").cast("string").alias(c) for c in have if c not in schema.fieldNames()]
    text = F.to_json(F.struct(*lost)) if lost else F.lit("{}")
    return rows.select(*columns, F.when(text != "{}", text).alias(rescued))


def schema_problems(rows: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Columns that are missing, unexpected or of another type."""
    have = {f.name: f.dataType.simpleString() for f in rows.schema}
    want = {f.name: f.dataType.simpleString() for f in schema}
    return {
        "missing": sorted(want.keys() - have.keys()),
        "unexpected": sorted(have.keys() - want.keys()),
        "mistyped": sorted(c for c in want.keys() & have.keys() if want[c] != have[c]),
    }


def snapshot(spark: SparkSession, name: str) -> dict:
    """Whether a catalog table is there, and its columns, types, partition columns and row count."""
    if not spark.catalog.tableExists(name):
        return {"exists": False}
    rows = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return {"exists": True, "columns": rows.columns, "types": dict(rows.dtypes), "partitions": parts, "rows": rows.count()}


def row_bytes(schema: T.StructType) -> int:
    """An estimate of a row's size by its types."""
    sizes = {
        "string": 64,
        "double": 8,
        "bigint": 8,
        "timestamp": 8,
        "timestamp_ntz": 8,
        "float": 4,
        "int": 4,
        "date": 4,
        "smallint": 2,
        "tinyint": 1,
        "boolean": 1,
    }
    return sum(16 if isinstance(f.dataType, T.DecimalType) else sizes.get(f.dataType.simpleString(), 32) for f in schema)


def rows_since(rows: DataFrame, column: str, start: str | Column) -> DataFrame:
    """Rows whose timestamp is at or after a start."""
    return rows.filter(F.col(column) >= (F.to_timestamp(F.lit(start)) if isinstance(start, str) else start))
