"""Message-broker streams.  The connector is a package of its own; without it, files or memory stand in with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that every broker row has.
BROKER_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def broker_options(
    servers: str,
    user: str | None = None,
    password: str | None = None,
    sink: bool = False,
    topic: str | None = None,
    starting: str = "latest",
    most_offsets: int | None = None,
    group: str | None = None,
    most_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a broker source (one or more topics, by commas) or sink, with SASL when a user is given."""
    out = {"kafka.bootstrap.servers": servers}
    if user is not None:
        login = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{user}" password="{password}";'
        out |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": login}
    if topic:
        out["topic" if sink else "subscribe"] = topic
    if not sink:
        out |= {"startingOffsets": starting, "failOnDataLoss": "false"}
        extra = {"kafka.group.id": group, "maxPartitions": most_partitions, "maxOffsetsPerTrigger": most_offsets}
        out |= {k: str(v) for k, v in extra.items() if v}
    return out


def broker_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A stream of broker rows; raises where the connector is not installed."""
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of broker rows from Parquet files."""
    reader = spark.readStream.schema(BROKER_SCHEMA)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def to_messages(rows: DataFrame, key: str) -> DataFrame:
    """key and value of each row for a broker sink: value is the row as JSON."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))
