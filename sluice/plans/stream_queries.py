"""Streaming queries: each drains what is there and gives the table that it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources import brokers
from sluice.sources.brokers import BROKER_SCHEMA, to_messages
from sluice.sources.folders import shared_path
from sluice.sources.tables import read_table
from sluice.streaming import pipelines as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query and the SQL that checks it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


TOPICS = ["signup", "purchase", "error", "view", "click"]


def _landing(rows: DataFrame, name: str) -> str:
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return path


@query("SELECT event_id, user_id, event_type, value, true AS has_metadata FROM events")
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental file ingestion with metadata; a second run finds nothing new."""
    rows = read_table(spark, sf_dir, "events")
    source, target, checkpoint = _landing(rows, "landing"), shared_path(spark, "bronze"), shared_path(spark, "checkpoint")
    for run in ("run-1", "run-2"):
        P.ingest_files(spark, source, rows.schema, target, checkpoint, run)
    out = spark.read.parquet(target)
    known = F.col("_ingested_at").isNotNull() & F.col("_source_file").isNotNull() & F.col("_source_modified_at").isNotNull() & (F.col("_run_id") == "run-1")
    return out.select("event_id", "user_id", "event_type", "value", known.alias("has_metadata"))


def _broker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as broker rows: a topic per type, some payloads malformed, every tenth row sent twice."""
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    body = F.to_json(F.struct(
        k.cast("string").alias("event_id"),
        F.when(F.col("event_type") == "purchase", "fraud_decision").otherwise("market_event").alias("event_type"),
        k.cast("string").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.col("value").alias("amount"),
        (F.col("value") > 20).alias("predicted_fraud"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("risk_score"),
    ))
    value = F.when(k % 50 == 0, F.lit("{broken")).otherwise(body)
    rows = e.select(
        k.cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (k % 3).cast("int").alias("partition"),
        k.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.explode(F.when(k % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_n"),
    )
    return rows.drop("_n").select(*(F.col(f.name).cast(f.dataType) for f in BROKER_SCHEMA))


@query("SELECT event_type AS topic, event_id AS \"offset\", event_id % 50 <> 0 AS parsed_json_valid FROM events")
def foreach_batch_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fan-out to a table for each of five topics; repeated offsets, within a run and in a replay, add nothing."""
    source, root = _landing(_broker_rows(spark, sf_dir), "topic"), shared_path(spark, "topics")
    for _ in range(2):  # the second run has a checkpoint of its own: a full replay
        stream = P.parsed(spark.readStream.schema(BROKER_SCHEMA).parquet(source))
        P.fan_out(stream, root, TOPICS, shared_path(spark, "checkpoint")).awaitTermination()
    rows = None
    for topic in TOPICS:
        own = P.topic_table(spark, root, topic).select("topic", "offset", "parsed_json_valid")
        rows = own if rows is None else rows.unionByName(own)
    return rows


@query("SELECT event_type AS topic, (count(*) + count(*) FILTER (WHERE event_id % 10 = 0))::BIGINT AS n FROM events GROUP BY 1")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each topic as the stream itself counted them, from its progress."""
    source = _landing(_broker_rows(spark, sf_dir), "topic")
    stream = P.observed(spark.readStream.schema(BROKER_SCHEMA).parquet(source), "inputs", F.col("topic"), TOPICS)
    query = stream.writeStream.foreachBatch(lambda rows, _: rows.write.format("noop").mode("overwrite").save()).option(
        "checkpointLocation",
        shared_path(spark, "checkpoint"),
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    totals = P.observed_totals(query.recentProgress, "inputs")
    return spark.createDataFrame([(t, int(totals[t])) for t in TOPICS], "topic string, n long")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream on a clock, polled until it has read everything and stopped then; every batch's progress counts once."""
    rows = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    source, target, n = _landing(rows, "landing"), shared_path(spark, "target"), rows.count()
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation",
        shared_path(spark, "checkpoint"),
    ).trigger(processingTime="200 milliseconds").start()
    P.run_until(query, lambda seen: sum(p["numInputRows"] for p in seen) >= n, 120)
    return spark.read.schema(rows.schema).parquet(target)


_MESSAGES_SQL = """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'transaction' WHEN 'signup' THEN 'authentication' ELSE 'market' END AS event_kind, ts AS event_timestamp, CASE WHEN event_type = 'purchase' THEN event_id::VARCHAR END AS transaction_id,
 CASE WHEN event_type IN ('purchase', 'signup') THEN user_id::VARCHAR END AS account_id, CASE WHEN event_type = 'purchase' THEN 10.0 WHEN event_type = 'view' THEN value END::DOUBLE AS market_price_usd, coalesce(event_type = 'signup' AND value > 50, false) AS login_success FROM events WHERE event_type IN ('purchase', 'signup', 'view')"""


@query(_MESSAGES_SQL)
def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of three topics as typed events; those of other topics are dropped."""
    e, kind = read_table(spark, sf_dir, "events"), F.col("event_type")
    paid, login = kind == "purchase", kind == "signup"
    body = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
            F.when(paid, F.col("event_id").cast("string")).alias("transaction_id"),
            F.when(paid | login, F.col("user_id").cast("string")).alias("account_id"),
            F.when(paid, F.lit(10.0)).alias("market_price_usd"),
            F.when(kind == "view", F.col("value")).alias("price_usd"),
            F.when(login, F.col("value") > 50).alias("login_success"),
        )
    )
    rows = e.select(
        F.lit(b"k").alias("key"),
        body.cast("binary").alias("value"),
        kind.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    out = P.typed_events(rows, {"purchase": "transaction", "signup": "authentication", "view": "market"})
    return out.select(
        F.col("offset").alias("event_id"),
        "event_kind",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        "transaction_id",
        "account_id",
        "market_price_usd",
        F.coalesce("login_success", F.lit(False)).alias("login_success"),
    )


@query("SELECT event_id::VARCHAR AS key, event_id, event_type FROM events")
def message_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's rows as messages, key and JSON, written by a sink and read again."""
    rows = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    source, target = _landing(rows, "landing"), shared_path(spark, "messages")
    messages = to_messages(spark.readStream.schema(rows.schema).parquet(source), "event_id")
    sink = messages.writeStream.format("parquet").option("path", target).option("checkpointLocation", shared_path(spark, "checkpoint"))
    sink.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema(messages.schema).parquet(target)
    return back.select("key", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.get_json_object("value", "$.event_type").alias("event_type"))


_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule required username=\"u\" password=\"p\";"
_OPTIONS = {"kafka.bootstrap.servers": "h:9093", "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": _LOGIN}
_SOURCE_OPTIONS = _OPTIONS | {"subscribe": "a,b", "startingOffsets": "earliest", "failOnDataLoss": "false", "kafka.group.id": "g", "maxPartitions": "1", "maxOffsetsPerTrigger": "10000"}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{kind}', '{k}', '{v}')" for kind, o in (("source", _SOURCE_OPTIONS), ("sink", _OPTIONS | {"topic": "d"})) for k, v in o.items()) + ") t(kind, name, value)")
def broker_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The options of a broker's source and sink."""
    source = brokers.broker_options("h:9093", "u", "p", topic="a,b", starting="earliest", most_offsets=10000, group="g", most_partitions=1)
    sink = brokers.broker_options("h:9093", "u", "p", sink=True, topic="d")
    return spark.createDataFrame([(kind, k, v) for kind, o in (("source", source), ("sink", sink)) for k, v in o.items()], "kind string, name string, value string")


@query("SELECT event_id, user_id, event_type AS kind, '{\"value\":\"' || user_id || '\"}' AS rescued, 'run-1' AS run_id FROM events")
def bronze_contract_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingestion into a contract: a column that it lacks is kept as JSON, and its partition column makes folders."""
    from pyspark.sql import types as T

    rows = read_table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("kind"), F.col("user_id").alias("value"))
    contract = T.StructType.fromDDL("event_id bigint, user_id bigint, kind string")
    source, target, checkpoint = _landing(rows, "landing"), shared_path(spark, "bronze"), shared_path(spark, "checkpoint")
    for run in ("run-1", "run-2"):
        P.ingest_files(spark, source, rows.schema, target, checkpoint, run, contract=contract, partitions=("kind",))
    return spark.read.parquet(target).select("event_id", "user_id", "kind", F.col("_rescued").alias("rescued"), F.col("_run_id").alias("run_id"))


@query("SELECT event_id::VARCHAR AS transaction_id, true AS consistent, true AS as_in_batch, 3 AS feature_count, true AS input_contract_ok, 24 AS fields FROM events WHERE event_type = 'purchase' AND event_id % 50 <> 0")
def stream_model_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model in a stream: 24-field decisions, map only, equal to the model's batch scores."""
    from sluice.operators import models
    from sluice.operators.scoring import decision_events

    numeric, categorical = ["amount", "minute"], ["weekday"]
    features = lambda rows, at: rows.withColumn("minute", F.minute(at).cast("double")).withColumn("weekday", F.date_format(at, "E"))
    batch = features(read_table(spark, sf_dir, "events").filter("event_type = 'purchase'").withColumn("amount", F.col("value")), "ts")
    model = models.fit_logistic(batch.withColumn("y", (F.col("value") > 40).cast("int")), numeric, categorical, "y", 20)
    source, target = _landing(_broker_rows(spark, sf_dir).dropDuplicates(["topic", "offset"]), "topic"), shared_path(spark, "decisions")
    stream = P.parsed(spark.readStream.schema(BROKER_SCHEMA).parquet(source)).filter("parsed_json_valid AND event_type = 'fraud_decision'")
    rows = features(
        stream.select("transaction_id", "asset", F.lit("US").alias("country"), "amount", F.col("amount").alias("transaction_amount_usd"), "event_at"),
        "event_at",
    )
    keep = ["transaction_id", "asset", "country", "transaction_amount_usd", "event_at"]
    score = lambda df: decision_events(
        models.scored(model, df, numeric, categorical, *keep),
        "score",
        "event_at",
        F.current_timestamp(),
        numeric + categorical,
        numeric + categorical,
    )
    P.score_stream(rows, score, lambda df, _: df.write.mode("append").parquet(target), shared_path(spark, "checkpoint")).awaitTermination()
    out = spark.read.parquet(target)
    again = models.scored(model, batch, numeric, categorical, "event_id").select(F.col("event_id").cast("string").alias("transaction_id"), "score")
    consistent = (F.col("predicted_fraud") == (F.col("fraud_probability") >= F.col("fraud_threshold"))) & ((F.col("decision") == "REVIEW") == F.col("predicted_fraud"))
    joined = out.join(again, "transaction_id")
    return joined.select(
        "transaction_id",
        consistent.alias("consistent"),
        (F.abs(F.col("score") - F.col("fraud_probability")) < 1e-9).alias("as_in_batch"),
        "feature_count",
        "input_contract_ok",
        F.lit(len(out.columns)).alias("fields"),
    )


@query("SELECT event_id::VARCHAR AS event_id, value > 20 AS predicted, CASE WHEN value > 20 THEN 'REVIEW' ELSE 'ALLOW' END AS decision FROM events WHERE event_type = 'purchase' AND event_id % 50 <> 0")
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map-only scoring of parsed rows."""
    from sluice.operators.scoring import decided

    source, target = _landing(_broker_rows(spark, sf_dir).dropDuplicates(["topic", "offset"]), "topic"), shared_path(spark, "scores")
    stream = P.parsed(spark.readStream.schema(BROKER_SCHEMA).parquet(source)).filter("parsed_json_valid AND event_type = 'fraud_decision'")
    score = lambda rows: decided(rows.drop("predicted"), "p", "event_at", F.current_timestamp(), 0.2000001)
    P.score_stream(
        stream.withColumn("p", F.col("amount") / 100),
        score,
        lambda rows, _: rows.write.mode("append").parquet(target),
        shared_path(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(target).select("event_id", "predicted", "decision")


@query("SELECT event_id::VARCHAR AS event_id, least(value / 100, 1.0) AS risk_score FROM events WHERE event_type = 'purchase' AND event_id % 50 <> 0 AND value > 20 AND least(value / 100, 1.0) >= 0.5")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream with repeats, one an event."""
    source, target = _landing(_broker_rows(spark, sf_dir), "topic"), shared_path(spark, "alerts")
    stream = P.parsed(spark.readStream.schema(BROKER_SCHEMA).parquet(source))
    P.alert_stream(stream, 0.5, lambda rows, _: rows.write.mode("append").parquet(target), shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(target).select("event_id", "risk_score")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling counts with a watermark, in complete mode."""
    rows = read_table(spark, sf_dir, "events")
    source, target = _landing(rows, "landing"), shared_path(spark, "counts")
    counts = P.windowed_counts(spark.readStream.schema(rows.schema).parquet(source), "ts", "event_type")
    sink = lambda df, _: df.write.mode("overwrite").parquet(target)
    counts.writeStream.outputMode("complete").foreachBatch(sink).option(
        "checkpointLocation",
        shared_path(spark, "checkpoint"),
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target)


@query("SELECT event_type AS topic, count(*) + count(*) FILTER (WHERE event_id % 10 = 0) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset FROM events GROUP BY 1")
def batch_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.batch_metrics(P.parsed(_broker_rows(spark, sf_dir))).select("topic", "n", "first_offset", "last_offset")
