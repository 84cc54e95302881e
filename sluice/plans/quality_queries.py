"""Queries of typing, quality rules, duplicates, keys and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import predicates as P
from sluice.functions import typing as Ty
from sluice.operators import latest as L
from sluice.operators import quality as Q
from sluice.sources import sinks
from sluice.sources.tables import conform, read_table, rows_since

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


@query("""
SELECT o_orderkey, concat_ws(';', CASE WHEN nullif(o_orderpriority, '5-LOW') IS NULL THEN 'priority_required' END,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus_approved_value' END,
  CASE WHEN o_totalprice > 400000 THEN 'price_range' END,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'date_order' END) AS reasons FROM orders""")
def dq_reason_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_reasons(spark, sf_dir).select("o_orderkey", F.concat_ws(";", Q.REASONS).alias("reasons"))


def _order_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    rules = Q.TableRules(required=("priority",), allowed={"o_orderstatus": ["F", "O"]}).rules(rows)
    rules += [
        Q.Rule("price_range", F.col("o_totalprice") > 400000),
        Q.Rule("date_order", P.out_of_order(F.col("o_orderdate"), F.lit("1997-12-31 23:59:59").cast("timestamp_ntz"))),
    ]
    return Q.with_reasons(rows, rules)


_REASONS_SQL = "SELECT unnest(list_filter([CASE WHEN o_orderpriority = '5-LOW' THEN 'priority_required' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus_approved_value' END, CASE WHEN o_totalprice > 400000 THEN 'price_range' END, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'date_order' END], lambda x: x IS NOT NULL)) AS reason FROM orders"


@query(f"SELECT reason, count(*) AS n FROM ({_REASONS_SQL}) GROUP BY reason")
def dq_reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reason_counts(_order_reasons(spark, sf_dir))


@query("SELECT count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS quarantined FROM (SELECT NOT (o_orderpriority = '5-LOW' OR o_orderstatus NOT IN ('F', 'O') OR o_totalprice > 400000 OR o_orderdate >= TIMESTAMP '1998-01-01') AS ok FROM orders)")
def dq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _order_reasons(spark, sf_dir)
    return Q.valid_rows(rows).select(F.lit(1).alias("v")).unionByName(Q.quarantined_rows(rows).select(F.lit(0).alias("v"))).agg(
        F.count(F.when(F.col("v") == 1, 1)).alias("valid"),
        F.count(F.when(F.col("v") == 0, 1)).alias("quarantined"),
    )


@query("SELECT coalesce(sum(n - 1), 0)::BIGINT AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def dq_duplicate_extra_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_extra_rows(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_mktsegment <> 'BUILDING')")
def dq_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = read_table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return Q.orphans(read_table(spark, sf_dir, "events"), "user_id", parents, "c_custkey").select("event_id", "user_id")


@query("""
WITH c AS (SELECT *, NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey AND n.n_regionkey <> 0) AS bad FROM customer c),
o AS (SELECT o.*, NOT EXISTS (SELECT 1 FROM c WHERE c.c_custkey = o.o_custkey AND NOT bad) AS bad FROM orders o),
l AS (SELECT l.*, NOT EXISTS (SELECT 1 FROM o WHERE o.o_orderkey = l.l_orderkey AND NOT bad) AS bad FROM lineitem l)
SELECT 'customer' AS table_name, count(*) AS n, count(*) FILTER (WHERE bad) AS invalid FROM c UNION ALL
SELECT 'orders', count(*), count(*) FILTER (WHERE bad) FROM o UNION ALL
SELECT 'lineitem', count(*), count(*) FILTER (WHERE bad) FROM l""")
def dq_fk_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read_table(spark, sf_dir, n)
    customer = Q.missing_parent(t("customer"), "c_nationkey", t("nation"), "n_nationkey", "nation_not_found", F.col("n_regionkey") != 0)
    orders = Q.missing_parent(t("orders"), "o_custkey", Q.valid_rows(customer), "c_custkey", "customer_not_found")
    lines = Q.missing_parent(t("lineitem"), "l_orderkey", Q.valid_rows(orders), "o_orderkey", "order_not_found")
    one = lambda name, df: df.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("n"),
        F.count(F.when(F.size(Q.REASONS) > 0, 1)).alias("invalid"),
    )
    return one("customer", customer).unionByName(one("orders", orders)).unionByName(one("lineitem", lines))


@query("""
WITH c AS (
SELECT 'orders_null_key' AS check_name, count(*) AS failures FROM orders WHERE o_orderkey IS NULL UNION ALL
SELECT 'orders_duplicate_key', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL
SELECT 'orders_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL
SELECT 'lineitem_duplicate_key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL
SELECT 'labels_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
SELECT check_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM c""")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read_table(spark, sf_dir, n)
    n = lambda df: df.agg(F.count("*").alias("n"))
    return Q.checks(
        ("orders_null_key", Q.null_keys(t("orders"), "o_orderkey")),
        ("orders_duplicate_key", Q.duplicate_keys(t("orders"), "o_orderkey")),
        ("orders_customer", n(Q.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey"))),
        ("lineitem_duplicate_key", Q.duplicate_keys(t("lineitem"), "l_orderkey", "l_linenumber")),
        ("labels_document", n(Q.orphans(t("labels"), "doc_id", t("documents"), "doc_id"))),
    )


@query("SELECT sum(failures)::BIGINT AS failures, CASE WHEN sum(failures) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT count(*) AS failures FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))")
def dq_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read_table(spark, sf_dir, n)
    return Q.overall(Q.checks(
        ("keys", Q.duplicate_keys(t("lineitem"), "l_orderkey", "l_linenumber")),
        ("parents", Q.orphans(t("orders"), "o_custkey", t("customer"), "c_custkey").agg(F.count("*").alias("n"))),
    ))


@query("""
SELECT l.doc_id, l.toxic, CASE WHEN o.o_orderkey IS NULL THEN 'no_transaction' ELSE 'before_transaction' END AS reason
FROM (SELECT *, doc_id * 3 AS k, TIMESTAMP '1995-01-01' + INTERVAL (doc_id % 900) DAY AS labelled_at FROM labels) l LEFT JOIN orders o ON o.o_orderkey = l.k
WHERE o.o_orderkey IS NULL OR l.labelled_at < o.o_orderdate""")
def dq_label_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels (of orders) without their order, or that lie before it."""
    at = (F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("doc_id") % 900).cast("int"))).cast("timestamp_ntz")
    labels = read_table(spark, sf_dir, "labels").withColumn("o_orderkey", F.col("doc_id") * 3).withColumn("labelled_at", at)
    return Q.label_timing(labels, read_table(spark, sf_dir, "orders"), "o_orderkey", "labelled_at", "o_orderdate").select("doc_id", "toxic", "reason")


_EPOCH_SQL = "SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000 WHEN 2 THEN epoch_us(ts) ELSE epoch_us(ts) * 1000 END AS raw, ts, event_id % 4 AS k FROM events"


@query(f"SELECT event_id, CASE k WHEN 0 THEN 's' WHEN 1 THEN 'ms' WHEN 2 THEN 'us' ELSE 'ns' END AS unit, CASE k WHEN 0 THEN make_timestamp(raw * 1000000) WHEN 1 THEN make_timestamp(raw * 1000) WHEN 2 THEN make_timestamp(raw) ELSE make_timestamp(raw // 1000) END AS at FROM ({_EPOCH_SQL})")
def epoch_unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    us, k = Ty.micros(F.col("ts")), F.col("event_id") % 4
    raw = F.when(k == 0, F.expr("us div 1000000")).when(k == 1, F.expr("us div 1000")).when(k == 2, F.col("us")).otherwise(F.col("us") * 1000)
    rows = read_table(spark, sf_dir, "events").withColumn("us", us).withColumn("raw", raw)
    return rows.select("event_id", Ty.epoch_unit(F.col("raw")).alias("unit"), Ty.epoch_to_timestamp(F.col("raw")).cast("timestamp_ntz").alias("at"))


@query("SELECT max(epoch_us(ts)) AS largest, 'us' AS unit FROM events")
def epoch_unit_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Ty.observed_unit(read_table(spark, sf_dir, "events").select(Ty.micros(F.col("ts")).alias("us")), "us")


@query("SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS name, nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN '   ' ELSE c_mktsegment END), '') AS segment, upper(trim(c_mktsegment || ' ')) || ',' || upper(trim(' x')) AS tags FROM customer")
def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "customer")
    blank = F.when(F.col("c_custkey") % 3 == 0, F.lit("   ")).otherwise(F.col("c_mktsegment"))
    tags = Ty.clean_array(F.array(F.concat("c_mktsegment", F.lit(" ")), F.lit(" x")))
    return rows.select(
        "c_custkey",
        Ty.clean_string(F.concat(F.lit("  "), "c_name", F.lit(" ")), "upper").alias("name"),
        Ty.clean_string(blank).alias("segment"),
        F.array_join(tags, ",").alias("tags"),
    )


def _hash_sql(*values: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(length({v})::VARCHAR || ':' || {v}, '-')" for v in values) + "))"


@query(f"SELECT o_orderkey, {_hash_sql('o_orderkey::VARCHAR', 'o_custkey::VARCHAR', 'status', 'priority', 'epoch_us(o_orderdate)::VARCHAR')} AS row_hash FROM (SELECT *, nullif(o_orderstatus, 'P') AS status, o_orderstatus || '|' || o_orderpriority AS priority FROM orders)")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").withColumn(
        "status",
        F.nullif("o_orderstatus", F.lit("P")),
    ).withColumn("us", Ty.micros(F.col("o_orderdate")))
    rows = rows.withColumn("priority", F.concat_ws("|", "o_orderstatus", "o_orderpriority"))  # a separator inside a value
    return rows.select("o_orderkey", Ty.row_hash(["o_orderkey", "o_custkey", "status", "priority", "us"]).alias("row_hash"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(20,8)) AS DOUBLE) AS price, TRY_CAST(l_returnflag AS DOUBLE) AS lost, l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS DOUBLE) IS NULL AS conversion_failed, l_shipdate::DATE::VARCHAR AS ship_date, (l_shipdate::DATE <> DATE '1999-01-01') AS date_differs FROM lineitem")
def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.exact_decimals(read_table(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice")), "price")
    lost = F.col("l_returnflag").try_cast("double")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.col("price").cast("double").alias("price"),
        lost.alias("lost"),
        P.lost_in_conversion(F.col("l_returnflag"), lost).alias("conversion_failed"),
        F.to_date("l_shipdate").cast("string").alias("ship_date"),
        P.date_differs(F.lit("1999-01-01").cast("date"), F.col("l_shipdate")).alias("date_differs"),
    )


@query("SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, '{\"event_type\":\"' || event_type || '\",\"value\":\"' || user_id || '\"}' AS rescued FROM events")
def rescued_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a schema lacks or cannot take, kept as JSON."""
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.IntegerType()),
    ])
    return conform(
        read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("user_id").alias("value")),
        schema,
    ).select("event_id", "user_id", F.col("event_type").cast("string").alias("event_type"), F.col("_rescued").alias("rescued"))


@query("SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def count_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_since(
        read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")),
        "ts",
        "2024-01-15 00:00:00",
    ).agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest(read_table(spark, sf_dir, "events"), ["user_id"], L.newest_by("ts", "event_id")).select("user_id", "event_id", "ts")


@query("SELECT user_id, count(*) AS n, 'duplicate_business_key_non_latest' AS quarantine_reason FROM (SELECT user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 1) GROUP BY user_id")
def dedup_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.older(
        read_table(spark, sf_dir, "events"),
        ["user_id"],
        L.newest_by("ts", "event_id"),
    ).groupBy("user_id", "quarantine_reason").agg(F.count("*").alias("n"))


_LABELS_SQL = "SELECT doc_id % 200 AS transaction_id, doc_id AS event_id, toxic = 1 AS is_fraud, CASE WHEN quality = 0 THEN 'INCONCLUSIVE' WHEN toxic = 1 THEN 'CONFIRMED_FRAUD' ELSE 'CLEARED' END AS investigation_status, doc_id % 7 AS label_timestamp FROM labels"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "labels")
    status = F.when(F.col("quality") == 0, "INCONCLUSIVE").when(F.col("toxic") == 1, "CONFIRMED_FRAUD").otherwise("CLEARED")
    at = F.col("doc_id") % 7
    return rows.select(
        (F.col("doc_id") % 200).alias("transaction_id"),
        F.col("doc_id").alias("event_id"),
        (F.col("toxic") == 1).alias("is_fraud"),
        status.alias("investigation_status"),
        at.alias("label_timestamp"),
        at.alias("ingestion_timestamp"),
        at.alias("source_timestamp"),
    )


@query(f"SELECT transaction_id, event_id, is_fraud, investigation_status FROM ({_LABELS_SQL}) WHERE investigation_status <> 'INCONCLUSIVE' QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY label_timestamp DESC, event_id DESC) = 1")
def label_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.resolve_labels(_labels(spark, sf_dir)).select("transaction_id", "event_id", "is_fraud", "investigation_status")


@query(f"SELECT coalesce(max(n), 1) AS most_labels, count(*) FILTER (WHERE n > 1) AS with_several FROM (SELECT count(*) AS n FROM ({_LABELS_SQL}) GROUP BY transaction_id)")
def label_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.label_multiplicity(_labels(spark, sf_dir), "transaction_id")


_PAIRS_SQL = "t AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 4 <> 0), s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 2 = 0)"


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = read_table(spark, sf_dir, "orders")
    t = o.filter("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    s = o.filter("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v"),
    )
    digest = lambda df: df.withColumn("h", Ty.row_hash(["v"]))
    return digest(t), digest(s)


@query(f"WITH {_PAIRS_SQL} SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NULL OR (s.k IS NOT NULL AND s.v <> t.v) THEN s.v ELSE t.v END AS v, CASE WHEN t.k IS NULL THEN 'insert' WHEN s.k IS NULL THEN 'keep' WHEN s.v = t.v THEN 'unchanged' ELSE 'update' END AS action FROM t FULL JOIN s ON t.k = s.k")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.upsert(*_pairs(spark, sf_dir), ["k"], "h").select("k", "v", F.col("_action").alias("action"))


@query(f"WITH {_PAIRS_SQL} SELECT CASE WHEN t.k IS NULL THEN 'insert' WHEN s.k IS NULL THEN 'keep' WHEN s.v = t.v THEN 'unchanged' ELSE 'update' END AS action, count(*) AS n FROM t FULL JOIN s ON t.k = s.k GROUP BY 1")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.upsert_counts(sinks.upsert(*_pairs(spark, sf_dir), ["k"], "h"))


@query(f"WITH {_PAIRS_SQL} SELECT s.k, s.v FROM s JOIN t ON s.k = t.k WHERE s.v <> t.v")
def upsert_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = _pairs(spark, sf_dir)
    return sinks.changed_rows(s, t, ["k"], "h").select("k", "v")


@query(f"WITH {_PAIRS_SQL} SELECT k, v FROM t UNION ALL SELECT k, v FROM s WHERE k NOT IN (SELECT k FROM t)")
def quarantine_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.insert_only(*_pairs(spark, sf_dir), ["k"]).select("k", "v")


_NUMS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} = 0) AS zeros, count(*) FILTER (WHERE {c} < 0) AS negatives, count(*) FILTER (WHERE isnan({c})) AS nans, count(*) FILTER (WHERE isinf({c})) AS infinities, min({c}) AS minimum, max({c}) AS maximum, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation FROM lineitem" for c in _NUMS))
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.metrics import profile_numeric as profile

    return profile(read_table(spark, sf_dir, "lineitem"), list(_NUMS)).withColumns({c: F.round(c, 6) for c in ("mean", "deviation")})


@query("SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS LAST) AS place FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, nullif({c}, 'R') AS value, count(*) AS n FROM lineitem GROUP BY ALL" for c in (
    "l_returnflag",
    "l_linestatus",
)) + ")")
def profile_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.metrics import profile_categorical as profile

    return profile(
        read_table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("R"))),
        ["l_returnflag", "l_linestatus"],
    )


@query("SELECT event_id, TRY_CAST(json_extract_string(CASE WHEN event_id % 10 = 0 THEN 'not json' ELSE props END, '$.k') AS DOUBLE) AS k, event_id % 10 <> 0 AS parsed_json_valid, sha256(CASE WHEN event_id % 10 = 0 THEN 'not json' ELSE props END) AS payload_sha256 FROM (SELECT * FROM events WHERE event_id % 10 <> 0) UNION ALL SELECT event_id, NULL, false, sha256('not json') FROM events WHERE event_id % 10 = 0")
def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 10 == 0, F.lit("not json")).otherwise(F.col("props"))
    rows = read_table(spark, sf_dir, "events").withColumn("raw", raw).withColumn("d", F.from_json("raw", "struct<k:bigint>"))
    return rows.select(
        "event_id",
        F.col("d.k").cast("double").alias("k"),
        F.col("d.k").isNotNull().alias("parsed_json_valid"),
        Ty.payload_hash(F.col("raw")).alias("payload_sha256"),
    )


@query("SELECT event_id, CASE event_type WHEN 'purchase' THEN 'BTC-USD' WHEN 'view' THEN 'ETH-USD' END AS product, coalesce(CASE WHEN value > 50 THEN value END, 0.0) AS amount, TIMESTAMP '1970-01-01' + INTERVAL (epoch_us(ts) // 60000000) MINUTE AS minute FROM events")
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events")
    return rows.select(
        "event_id",
        Ty.mapped(F.col("event_type"), {"purchase": "BTC-USD", "view": "ETH-USD"}).alias("product"),
        Ty.first_present(F.when(F.col("value") > 50, F.col("value")), F.lit(0.0)).alias("amount"),
        Ty.minute_of(F.col("ts")).alias("minute"),
    )


@query("SELECT event_id, CASE WHEN event_type IN ('view') THEN true ELSE false END AS flagged, CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN 0 END::DOUBLE AS target FROM events")
def target_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "purchase", " TRUE ").when(kind == "error", "0").otherwise("maybe")
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        Ty.as_bool(F.when(kind == "view", "Yes").otherwise("no")).alias("flagged"),
        Ty.normal_target(text).cast("double").alias("target"),
    )


_LINKS = (
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)


@query(" UNION ALL ".join(f"SELECT '{t}.{c}->{p}.{k}' AS check_name, count(*) AS failures, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {p})" for t, c, p, k in _LINKS))
def dq_integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {x for t, _, p, _ in _LINKS for x in (t, p)}
    return Q.integrity_report({n: read_table(spark, sf_dir, n) for n in names}, list(_LINKS))


@query("SELECT 'null_keys' AS check_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS failures, 'PASS' AS status FROM orders UNION ALL SELECT 'repeated_keys', count(*) - count(DISTINCT o_orderkey), 'PASS' FROM orders UNION ALL SELECT 'other_status', count(*) FILTER (WHERE o_orderstatus <> 'F'), 'FAIL' FROM orders")
def dq_final_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.final_table_check(read_table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus", "F")


@query("SELECT count(*) AS n FROM events WHERE event_type = 'view' OR trim(props) = ''")
def dq_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("_run", F.when(F.col("event_type") != "view", "run-1"))
    return Q.incomplete_metadata(rows, "_run", "props")


@query("SELECT event_id FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR > ts")
def dq_future_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that would use the candle they are in, which ends after them."""
    rows = read_table(spark, sf_dir, "events").withColumn("end", (Ty.hour_of(F.col("ts")) + F.expr("interval 1 hour")).cast("timestamp_ntz"))
    return Q.from_the_future(rows, "end", "ts").select("event_id")


@query("SELECT count(*) FILTER (WHERE c_acctbal < 0) AS c_acctbal, count(*) FILTER (WHERE c_custkey < 0) AS c_custkey FROM customer")
def negative_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.negative_counts(read_table(spark, sf_dir, "customer"), "c_acctbal", "c_custkey")
