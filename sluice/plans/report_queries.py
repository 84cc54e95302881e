"""Queries of segments, model choice, registries, distributions, sinks, run logs and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import features as Fe
from sluice.operators import market as M
from sluice.operators import metrics as Me
from sluice.operators import models as Mo
from sluice.operators import scoring as S
from sluice.plans import gold_queries as Gq
from sluice.sources import sinks
from sluice.sources.folders import shared_path
from sluice.sources.tables import inspect_layout, read_table, scan, snapshot

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


_SEGMENT = "SELECT '{name}' AS segment_name, {value} AS segment_value, count(*) AS row_count, count(*) FILTER (WHERE is_fraud) AS fraud_count, round(avg(score), 6) AS average_probability, count(*) FILTER (WHERE predicted) AS high_risk_count, round(count(*) FILTER (WHERE is_fraud AND predicted) / nullif(count(*) FILTER (WHERE predicted), 0), 6) AS fraud_precision, round(count(*) FILTER (WHERE is_fraud AND predicted) / nullif(count(*) FILTER (WHERE is_fraud), 0), 6) AS fraud_recall FROM gold WHERE outcome IS NOT NULL GROUP BY ALL"
_SEGMENTS = {
    "asset": "segment",
    "transaction_type": "(doc_id % 3)::VARCHAR",
    "customer_risk_tier": "coalesce(nullif(source, 'src1'), '__MISSING__')",
    "cold_start_status": "CASE WHEN doc_id % 4 = 0 THEN 'cold_start' ELSE 'existing_history' END",
}


@query(f"{Gq._GOLD} " + " UNION ALL ".join(_SEGMENT.format(name=n, value=v) for n, v in _SEGMENTS.items()))
def segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by asset, type, risk tier and cold start, in one pass over the rows."""
    rows = Gq.gold(spark, sf_dir).filter("outcome IS NOT NULL")
    previous = F.when(F.col("doc_id") % 8 != 0, (F.col("doc_id") % 4).cast("int"))
    segments = {
        "asset": F.col("segment"),
        "transaction_type": F.col("doc_id") % 3,
        "customer_risk_tier": F.nullif("source", F.lit("src1")),
        "cold_start_status": Me.cold_start(previous),
    }
    out = Me.segment_metrics(rows, segments, F.col("is_fraud"), F.col("predicted"), F.col("score"))
    return out.withColumns({c: F.round(c, 6) for c in ("average_probability", "fraud_precision", "fraud_recall")})


@query("""WITH c AS (SELECT 'model' || (doc_id % 5) AS name, avg(quality) AS recall, count(*) FILTER (WHERE toxic = 1) AS fp, avg(toxic) AS pr_auc, avg(quality) AS "precision" FROM labels GROUP BY 1)
SELECT name, fp FROM c WHERE recall >= 0.2 ORDER BY fp, pr_auc DESC NULLS LAST, "precision" DESC NULLS LAST, name LIMIT 1""")
def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the models with enough recall the one with fewest false positives, then by PR-AUC and precision."""
    rows = read_table(spark, sf_dir, "labels").groupBy(F.concat(F.lit("model"), F.col("doc_id") % 5).alias("name"))
    candidates = rows.agg(
        F.avg("quality").alias("recall"),
        F.count(F.when(F.col("toxic") == 1, 1)).alias("fp"),
        F.avg("toxic").alias("pr_auc"),
        F.avg("quality").alias("precision"),
    )
    return Me.chosen_model(candidates, 0.2).select("name", "fp")


@query("SELECT * FROM (VALUES ('logistic', 1, NULL, 0.5), ('logistic', 2, 'candidate', 0.6), ('boosted', 1, 'candidate', 0.7)) t(name, version, alias, recall)")
def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions and aliases: a new version moves no alias; an alias is on one version."""
    rows = spark.createDataFrame([], "name string, version int, alias string, metrics map<string,double>")
    for name, recall in (("logistic", 0.5), ("logistic", 0.6), ("boosted", 0.7)):
        rows = Mo.registered(rows, name, {"recall": recall})
    rows = Mo.aliased(Mo.aliased(Mo.aliased(rows, "logistic", 1, "candidate"), "logistic", 2, "candidate"), "boosted", 1, "candidate")
    return rows.select("name", "version", "alias", F.col("metrics")["recall"].alias("recall"))


_DISTRIBUTION = """WITH f AS (SELECT count(*) FILTER (WHERE toxic = 1) AS frauds FROM labels), t AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id % 10 <> 0) AS done FROM documents)
SELECT name, round(value, 9) AS value FROM (SELECT unnest(['confirmed_fraud_count', 'transaction_count', 'completed_transaction_count', 'fraud_rate', 'completed_transaction_fraud_rate', 'fraud_rate_within_approved_range']) AS name,
 unnest([frauds, n, done, frauds / n, frauds / done, (frauds / n BETWEEN 0.005 AND 0.01)::INT]::DOUBLE[]) AS value FROM f, t
UNION ALL SELECT 'scenario:' || (doc_id % 6), count(*) FROM labels WHERE toxic = 1 GROUP BY 1)"""


@query(_DISTRIBUTION)
def fraud_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of frauds among all and completed transactions, and rows of each scenario."""
    paid = read_table(spark, sf_dir, "documents").withColumn(
        "transaction_status",
        F.when(F.col("doc_id") % 10 == 0, "PENDING").otherwise("COMPLETED"),
    )
    labels = read_table(spark, sf_dir, "labels").withColumn("is_fraud", F.col("toxic") == 1)
    audit = labels.select("doc_id", (F.col("doc_id") % 6).cast("string").alias("scenario_id"), F.col("is_fraud").alias("label_expected"))
    return Me.fraud_distribution(paid, labels, audit, "doc_id").withColumn("value", F.round("value", 9))


@query("SELECT a AS start_epoch, least(a + 18000, 1704700000) AS end_epoch FROM (SELECT unnest(generate_series(1704067200, 1704699999, 18000)) AS a)")
def request_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of at most 300 one-minute candles."""
    return spark.createDataFrame(M.request_windows(1704067200, 1704700000), "start_epoch long, end_epoch long")


@query("SELECT ts::DATE::VARCHAR AS event_date, count(*) AS n, round(sum(round(value, 1)), 4) AS total FROM events GROUP BY 1")
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in folders by date, written twice, read by an explicit schema; a replaced table holds only the last write."""
    rows = read_table(spark, sf_dir, "events").select("event_id", F.col("value").alias("amount"), F.to_date("ts").alias("event_date"))
    path = shared_path(spark, "partitioned")
    sinks.write_partitioned(rows.limit(3), path, "event_date")
    sinks.write_partitioned(sinks.exact_decimals(rows, "amount", digits=1), path, "event_date")
    layout = inspect_layout(spark, path)
    if layout.partitions != ["event_date"] or not layout.files:
        raise ValueError(f"unexpected layout {layout}")
    from pyspark.sql import types as T

    back = scan(spark, path, T.StructType.fromDDL("event_id bigint, amount decimal(20,1), event_date date"), path)
    return back.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count("*").alias("n"),
        F.round(F.sum("amount").cast("double"), 4).alias("total"),
    )


@query("SELECT 'orders' AS table_name, count(*) AS n_rows, 1 AS files, '' AS partitions FROM orders UNION ALL SELECT 'customer', count(*), 1, '' FROM customer")
def sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single files, logged as they are written, and the manifest of the run."""
    log, paths = shared_path(spark, "log"), {n: shared_path(spark, n) for n in ("orders", "customer")}
    for name, path in paths.items():
        sinks.logged(read_table(spark, sf_dir, name), path, log, "run-1", name, sinks.write_single)
    return sinks.manifest(spark, paths, "run-1", "v1").select("table_name", "n_rows", "files", "partitions")


@query("SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) - 5 AS delta, true AS fresh, 'run-2' AS run_id FROM orders")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest entry, the change of rows and the age of a table that a sink wrote twice."""
    log, path, rows = shared_path(spark, "log"), shared_path(spark, "table"), read_table(spark, sf_dir, "orders")
    sinks.logged(rows.limit(5), path, log, "run-1", "orders")
    sinks.logged(rows, path, log, "run-2", "orders")
    out = sinks.latest_run(spark, log).join(sinks.row_deltas(spark, log), "table_name").join(sinks.freshness(spark, log), "table_name")
    return out.select("table_name", "n_rows", "delta", F.col("age_seconds").between(0, 3600).alias("fresh"), "run_id")


@query("SELECT * FROM (VALUES (1, true, 0, 'a:bigint'), (2, false, 3, 'a:bigint'), (3, true, 2, 'a:string,b:double')) t(step, made, n, columns)")
def sink_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table that is made if it is missing, filled, and replaced with another schema."""
    import uuid

    name, found = f"sink_{uuid.uuid4().hex}", []

    def look(step: int, made: bool) -> None:
        s = snapshot(spark, name)
        found.append((step, made, s["rows"], ",".join(f"{c}:{t}" for c, t in s["types"].items())))

    try:
        rows = spark.range(3).select(F.col("id").alias("a"))
        look_made = sinks.create_if_missing(rows, name)
        look(1, look_made)
        made = sinks.create_if_missing(rows, name)
        rows.write.mode("append").saveAsTable(name)
        look(2, made)
        sinks.overwrite_table(spark.createDataFrame([("x", 1.0), ("y", 2.0)], "a string, b double"), name)
        look(3, True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(found, "step int, made boolean, n long, columns string")


@query("SELECT 'TEST ALERT' AS title, 'test-transaction' AS transaction_id, 1.0::DOUBLE AS probability, true AS is_test")
def alert_test_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.test_alert(spark.range(1))


@query("SELECT e.event_id, c.candle_end AS state_at FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10') e ASOF JOIN (SELECT event_type AS product, date_trunc('hour', ts) + INTERVAL 1 HOUR AS candle_end FROM events GROUP BY 1, 2) c ON e.event_type = c.product AND e.ts >= c.candle_end")
def asof_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join for rows that must have a state; a row without one would stop it."""
    e = read_table(spark, sf_dir, "events")
    candles = M.candles(e, "event_type", "ts", "value", "event_id")
    out = M.as_of(e.filter("ts >= TIMESTAMP_NTZ '2024-01-10'"), candles, "event_type", "ts", "product", "candle_end", ["close"], required=True)
    return out.select("event_id", "state_at")


@query("""WITH s AS (SELECT * FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21')
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AND (user_id IN (SELECT user_id FROM s) OR json_extract_string(props, '$.k') IN (SELECT json_extract_string(props, '$.k') FROM s))""")
def history_of_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of history of the users and devices that one day's subjects have."""
    e = read_table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    subjects = e.filter((F.col("event_type") == "error") & (F.col("ts") >= day("2024-01-20")) & (F.col("ts") < day("2024-01-21")))
    return Fe.history_for(e, subjects, {"user_id": "user_id", "k": "k"}, "ts", day("2024-01-10"), day("2024-01-20")).select("event_id")
