"""Streams: ingestion to tables, idempotent fan-out, scoring, alerts, metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.predicates import is_alert
from sluice.functions.typing import event_time, payload_hash
from sluice.sources.tables import conform, with_ingestion_metadata

COORDINATES = ["topic", "partition", "offset"]
#: Payload of all topics in one schema.
EVENT_SCHEMA = "struct<event_id:string,event_type:string,transaction_id:string,account_id:string,device_id:string,event_timestamp:string,prediction_timestamp:string,asset:string,amount:double,predicted_fraud:boolean,fraud_probability:double,risk_score:double,is_fraud:boolean>"


def ingest_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    run_id: str,
    files_per_trigger: int = 100,
    contract: T.StructType | None = None,
    partitions: tuple[str, ...] = (),
) -> StreamingQuery:
    """Reads files that are new since the last run, with ingestion metadata, appends them to a table and stops.

    schema: the files'; contract: the table's, where what does not fit goes to the rescued column; partitions: folders of
    the target, by columns of the contract.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    rows = with_ingestion_metadata(rows if contract is None else conform(rows, contract), run_id)
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    query = (writer.partitionBy(*partitions) if partitions else writer).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def parsed(broker: DataFrame) -> DataFrame:
    """Broker rows with raw payload, its hash, the parsed fields and whether the payload was valid; bad ones are kept and flagged."""
    raw = broker.select(
        *COORDINATES,
        F.col("timestamp").alias("broker_timestamp"),
        F.col("key").cast("string").alias("raw_key"),
        F.col("value").cast("string").alias("raw_payload"),
    )
    data = raw.withColumn("_d", F.from_json("raw_payload", EVENT_SCHEMA))
    fields = T.StructType.fromDDL(EVENT_SCHEMA.removeprefix("struct<").removesuffix(">")).fieldNames()
    out = data.select(
        *raw.columns,
        payload_hash(F.col("raw_payload")).alias("payload_sha256"),
        F.col("_d.event_id").isNotNull().alias("parsed_json_valid"),
        *(F.col(f"_d.{c}").alias(c) for c in fields if not c.endswith("_timestamp")),
        *(F.expr(f"try_to_timestamp(_d.{c})").alias(c) for c in fields if c.endswith("_timestamp")),
    )
    return out.withColumn(
        "event_at",
        event_time(F.col("prediction_timestamp"), F.col("event_timestamp"), F.col("broker_timestamp"), F.current_timestamp()),
    )


#: The payloads of transactions, logins and market messages: what one lacks is null in its messages.
MESSAGE_SCHEMA = "struct<event_timestamp:string,source_timestamp:string,ingestion_timestamp:string,transaction_id:string,account_id:string,device_id:string,source_wallet_id:string,destination_wallet_id:string,asset:string,transaction_type:string,country:string,crypto_quantity:double,market_price_usd:double,transaction_amount_usd:double,price_usd:double,product_id:string,trade_id:string,login_success:boolean>"


def typed_events(broker: DataFrame, topics: dict[str, str]) -> DataFrame:
    """Broker rows as typed events of a kind by topic (topics: topic to kind); rows of other topics are dropped.

    The kinds' payloads share their fields' names and types, so each message is parsed once, by all fields together.
    """
    rows = broker.withColumn("event_kind", kinds(F.col("topic"), topics)).filter("event_kind IS NOT NULL")
    d = rows.withColumn("_d", F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA))
    times = [F.expr(f"try_to_timestamp(_d.{c})").alias(c) for c in ("event_timestamp", "source_timestamp", "ingestion_timestamp")]
    plain = (
        "transaction_id",
        "account_id",
        "device_id",
        "source_wallet_id",
        "destination_wallet_id",
        "asset",
        "transaction_type",
        "country",
        "crypto_quantity",
        "transaction_amount_usd",
        "product_id",
        "trade_id",
        "login_success",
    )
    price = F.coalesce("_d.market_price_usd", "_d.price_usd").alias("market_price_usd")
    return d.select(
        "event_kind",
        *times,
        *COORDINATES,
        F.col("timestamp").alias("broker_timestamp"),
        *(F.col(f"_d.{c}").alias(c) for c in plain),
        price,
    )


def kinds(topic: Column, names: dict[str, str]) -> Column:
    """The kind of event of a topic; null for unknown ones."""
    out = F.lit(None).cast("string")
    for key, kind in names.items():
        out = F.when(topic == key, kind).otherwise(out)
    return out


def append_new(rows: DataFrame, target: str, keys: list[str], within: str = "offset", by: tuple[str, ...] = ()) -> int:
    """Appends to a Parquet table the rows whose keys it lacks, one a key: a replayed batch adds nothing.  Gives the batch's rows.

    Only the part of the table whose `within`, a column that grows as rows come, lies between the batch's ends is read:
    the bounds reach the scan, which skips all files (and row groups) outside them.  by: columns of the table's folders.
    """
    spark = rows.sparkSession
    n, low, high = rows.agg(F.count("*"), F.min(within), F.max(within)).head()
    if not n:
        return 0
    new = rows.dropDuplicates(keys)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        known = spark.read.schema(rows.schema).parquet(target).filter(F.col(within).between(low, high)).select(*keys)
        new = new.join(known, keys, "left_anti")
    (new.write.partitionBy(*by) if by else new.write).mode("append").parquet(target)
    return n


def topic_table(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The table of a topic below the root of a fan-out: one folder's files."""
    return spark.read.option("basePath", root).parquet(f"{root}/topic={topic}")


def fan_out(stream: DataFrame, root: str, topics: list[str], checkpoint: str, **trigger) -> StreamingQuery:
    """One stream of parsed broker rows to a table per topic, replay-safe by topic, partition and offset.

    The tables are folders of one root, so a batch is one write, whatever the number of topics.
    """

    def batch(rows: DataFrame, _: int) -> None:
        rows.persist()
        append_new(rows.filter(F.col("topic").isin(topics)), root, COORDINATES, by=("topic",))
        rows.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def observed(stream: DataFrame, name: str, kind: Column, names: list[str]) -> DataFrame:
    """Counts rows of each kind into the query's progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), *(F.count(F.when(kind == k, 1)).alias(k) for k in names))


def observed_totals(progress: list[dict], name: str) -> dict[str, int]:
    """The sums of an observation over the batches of a query's progress."""
    import json

    out: dict[str, int] = {}
    for p in progress:
        d = p if isinstance(p, dict) else json.loads(p.json)
        found = d.get("observedMetrics", {}).get(name) or {}
        for key, n in (found.asDict() if hasattr(found, "asDict") else found).items():
            out[key] = out.get(key, 0) + (n or 0)
    return out


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Map-only scoring: no state, no exchange."""
    return score(stream).writeStream.foreachBatch(sink).option(
        "checkpointLocation",
        checkpoint,
    ).trigger(**(trigger or {"availableNow": True})).start()


def alert_stream(
    stream: DataFrame,
    threshold: float,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    late: str = "1 hour",
    **trigger,
) -> StreamingQuery:
    """Alerts of parsed decisions, one an event id within the watermark; bad payloads are no alerts."""
    hit = stream.filter(F.col("parsed_json_valid") & is_alert(
        F.col("event_type"),
        F.col("predicted_fraud"),
        F.col("fraud_probability"),
        F.col("risk_score"),
        threshold,
    ))
    single = hit.withWatermark("event_at", late).dropDuplicatesWithinWatermark(["event_id"])
    return single.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def offset_deltas(progress: dict) -> dict[str, int]:
    """Offsets read per topic, of one progress record."""
    import json

    read = lambda x: json.loads(x) if isinstance(x, str) else (x or {})
    out: dict[str, int] = {}
    for source in progress.get("sources", []):
        start, end = read(source.get("startOffset")), read(source.get("endOffset"))
        for topic, parts in end.items():
            if isinstance(parts, dict):
                out[topic] = out.get(topic, 0) + sum(n - start.get(topic, {}).get(p, 0) for p, n in parts.items())
    return out


def run_until(query: StreamingQuery, enough: Callable[[list[dict]], bool], seconds: float, pause: float = 0.2) -> list[dict]:
    """Polls a query until its progress is enough or time is up, then stops it; gives each batch's progress once."""
    import json
    import time

    seen: dict[int, dict] = {}
    end = time.time() + seconds
    while time.time() < end and query.isActive:
        for p in query.recentProgress:
            d = p if isinstance(p, dict) else json.loads(p.json)
            seen[d["batchId"]] = d
        if enough(list(seen.values())):
            break
        time.sleep(pause)
    query.stop()
    return [seen[k] for k in sorted(seen)]


def windowed_counts(stream: DataFrame, ts: str, by: str, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Tumbling counts with a watermark."""
    at = stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    return at.groupBy(F.window("_at", size), by).agg(F.count("*").alias("n")).select(
        F.col("window.start").cast("timestamp_ntz").alias("start"),
        by,
        "n",
    )


def batch_metrics(rows: DataFrame) -> DataFrame:
    """Rows, first and last offset, and the newest event of each topic of a batch."""
    return rows.groupBy("topic").agg(
        F.count("*").alias("n"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.max_by("event_id", F.struct("event_at", "offset")).alias("newest_event"),
    )
