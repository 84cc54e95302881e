"""Queries of the domain's rule sets, cross-table rules, formats, schemas and ids.

Roles: orders are transactions, customers accounts, suppliers devices, parts wallets, documents' labels fraud labels;
columns that the tables lack follow from keys, with faults at known rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import predicates as P
from sluice.functions import typing as Ty
from sluice.operators import quality as Q
from sluice.sources.tables import read_table, row_bytes

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


def _reasons_sql(rules: dict[str, str]) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules.items()) + ") AS reasons"


def _reasons(rows: DataFrame, rules: list[Q.Rule], *keep: str) -> DataFrame:
    return Q.with_reasons(rows, rules).select(*keep, F.concat_ws(";", Q.REASONS).alias("reasons"))


def _shifted(ts: Column, seconds: Column) -> Column:
    return (ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("timestamp_ntz")


_ORDER = {
    "event_timestamp_after_source_timestamp": "event_timestamp > source_timestamp",
    "source_timestamp_after_ingestion_timestamp": "source_timestamp > ingestion_timestamp",
}
_TIMES_SQL = "{ts} AS event_timestamp, {ts} + INTERVAL ({k} % 19 - 1) SECOND AS source_timestamp, {ts} + INTERVAL ({k} % 19 - 1 + {k} % 23 - 1) SECOND AS ingestion_timestamp"


def _times(ts: str, k: str) -> list[Column]:
    """Event, source and ingestion time, out of order in some rows."""
    key, at = F.col(k), F.col(ts)
    return [
        at.alias("event_timestamp"),
        _shifted(at, key % 19 - 1).alias("source_timestamp"),
        _shifted(at, key % 19 - 1 + key % 23 - 1).alias("ingestion_timestamp"),
    ]


_TX_SQL = f"""SELECT o_orderkey AS transaction_id, o_custkey AS account_id, o_orderkey % 12 AS device_id, {_TIMES_SQL.format(ts='o_orderdate', k='o_orderkey')},
 CASE o_orderkey % 3 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL' ELSE 'TRANSFER' END AS transaction_type, o_orderkey % 5 - 1 AS crypto_quantity, round(o_totalprice, 2) AS market_price_usd,
 (o_orderkey % 5 - 1) * round(o_totalprice, 2) + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS transaction_amount_usd,
 CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 190 END AS source_wallet_id, CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey % 190 ELSE o_orderkey % 210 + 1 END END AS destination_wallet_id FROM orders"""


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    exact = lambda c: c.cast("decimal(20,8)")
    price, quantity = exact(F.round("o_totalprice", 2)), exact(k % 5 - 1)
    amount = exact(quantity * price) + F.when(k % 17 == 0, exact(F.lit(1))).otherwise(exact(F.lit(0)))
    return read_table(spark, sf_dir, "orders").select(
        k.alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        (k % 12).alias("device_id"),
        *_times("o_orderdate", "o_orderkey"),
        F.when(k % 3 == 0, "DEPOSIT").when(k % 3 == 1, "WITHDRAWAL").otherwise("TRANSFER").alias("transaction_type"),
        quantity.alias("crypto_quantity"),
        price.alias("market_price_usd"),
        exact(amount).alias("transaction_amount_usd"),
        F.when(k % 7 != 0, k % 190).alias("source_wallet_id"),
        F.when(k % 11 != 0, F.when(k % 13 == 0, k % 190).otherwise(k % 210 + 1)).alias("destination_wallet_id"),
    )


_TX_RULES = _ORDER | {
    "crypto_quantity_not_positive": "crypto_quantity <= 0",
    "market_price_usd_not_positive": "market_price_usd <= 0",
    "transaction_amount_usd_negative": "transaction_amount_usd < 0",
    "source_and_destination_wallet_identical": "source_wallet_id = destination_wallet_id",
    "deposit_missing_destination_wallet_id": "transaction_type = 'DEPOSIT' AND destination_wallet_id IS NULL",
    "outgoing_transaction_missing_source_wallet_id": "transaction_type <> 'DEPOSIT' AND source_wallet_id IS NULL",
    "outgoing_transaction_missing_destination_wallet_id": "transaction_type <> 'DEPOSIT' AND destination_wallet_id IS NULL",
    "transaction_amount_mismatch_quantity_times_price": "abs(transaction_amount_usd - crypto_quantity * market_price_usd) > 0.01",
}


@query(f"SELECT transaction_id, {_reasons_sql(_TX_RULES)} FROM ({_TX_SQL})")
def dq_transaction_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_transactions(spark, sf_dir), Q.transaction_rules(), "transaction_id")


_CANDLE_RULES = {
    **{f"{x}_price_usd_not_positive": f"{x}_price_usd <= 0" for x in ("open", "high", "low", "close")},
    "volume_negative": "volume < 0",
    "granularity_not_60_seconds": "granularity_seconds <> 60",
    "candle_end_not_start_plus_60_seconds": "candle_end_timestamp <> candle_start_timestamp + INTERVAL 60 SECOND",
    "high_price_below_ohlc_values": "high_price_usd < greatest(open_price_usd, close_price_usd, low_price_usd)",
    "low_price_above_ohlc_values": "low_price_usd > least(open_price_usd, close_price_usd, high_price_usd)",
}


@query(f"""SELECT event_id, {_reasons_sql(_CANDLE_RULES)} FROM (SELECT event_id, value - 5 AS open_price_usd, value - 5 + event_id % 7 - 1 AS high_price_usd, value - 5 - (event_id % 6 - 1) AS low_price_usd, value - 4.5 AS close_price_usd,
 event_id % 11 - 1 AS volume, CASE WHEN event_id % 13 = 0 THEN 30 ELSE 60 END AS granularity_seconds, ts AS candle_start_timestamp, ts + INTERVAL (60 + (event_id % 17 = 0)::INT) SECOND AS candle_end_timestamp FROM events)""")
def dq_candle_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    rows = read_table(spark, sf_dir, "events").select(
        "event_id",
        (v - 5).alias("open_price_usd"),
        (v - 5 + k % 7 - 1).alias("high_price_usd"),
        (v - 5 - (k % 6 - 1)).alias("low_price_usd"),
        (v - 4.5).alias("close_price_usd"),
        (k % 11 - 1).alias("volume"),
        F.when(k % 13 == 0, 30).otherwise(60).alias("granularity_seconds"),
        F.col("ts").alias("candle_start_timestamp"),
        _shifted(F.col("ts"), 60 + (k % 17 == 0).cast("int")).alias("candle_end_timestamp"),
    )
    return _reasons(rows, Q.candle_rules(), "event_id")


_LABEL_RULES = _ORDER | {
    "event_timestamp_not_equal_label_timestamp": "event_timestamp <> label_timestamp",
    "fraud_type_required_for_fraud": "is_fraud AND fraud_type IS NULL",
    "fraud_type_must_be_null_for_non_fraud": "NOT is_fraud AND fraud_type IS NOT NULL",
    "confirmed_fraud_status_requires_is_fraud_true": "investigation_status = 'CONFIRMED_FRAUD' AND NOT is_fraud",
    "cleared_status_requires_is_fraud_false": "investigation_status = 'CLEARED' AND is_fraud",
}
_LABELS_SQL = f"""SELECT doc_id, {_TIMES_SQL.format(ts="(TIMESTAMP '2024-01-01' + INTERVAL (doc_id) HOUR)", k='doc_id')}, TIMESTAMP '2024-01-01' + INTERVAL (doc_id) HOUR + INTERVAL ((doc_id % 4 = 0)::INT) SECOND AS label_timestamp,
 CASE WHEN doc_id % 9 <> 0 THEN toxic = 1 END AS is_fraud, CASE WHEN doc_id % 5 < 2 THEN 'STRUCTURING' END AS fraud_type, CASE doc_id % 3 WHEN 0 THEN 'CONFIRMED_FRAUD' WHEN 1 THEN 'CLEARED' ELSE 'INCONCLUSIVE' END AS investigation_status FROM labels"""


def _fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    rows = read_table(spark, sf_dir, "labels").withColumn(
        "at",
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=k.cast("int"))).cast("timestamp_ntz"),
    )
    status = F.when(k % 3 == 0, "CONFIRMED_FRAUD").when(k % 3 == 1, "CLEARED").otherwise("INCONCLUSIVE")
    return rows.select(
        "doc_id",
        *_times("at", "doc_id"),
        _shifted(F.col("at"), (k % 4 == 0).cast("int")).alias("label_timestamp"),
        F.when(k % 9 != 0, F.col("toxic") == 1).alias("is_fraud"),
        F.when(k % 5 < 2, "STRUCTURING").alias("fraud_type"),
        status.alias("investigation_status"),
    )


@query(f"SELECT doc_id, {_reasons_sql(_LABEL_RULES)} FROM ({_LABELS_SQL})")
def dq_label_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(_fraud_labels(spark, sf_dir), Q.label_rules(), "doc_id")


@query(f"SELECT event_id, {_reasons_sql({'ip_address_required': 'event_id % 29 = 0', 'ip_ip_address_format': 'event_id % 10 = 3', 'country_country_code_format': 'event_id % 8 = 0'} | _ORDER | {'event_date_not_derived_from_event_timestamp': 'event_id % 31 = 0'})} FROM (SELECT event_id, {_TIMES_SQL.format(ts='ts', k='event_id')} FROM events)")
def dq_authentication_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins: a required address, formats, order of times and the partition date."""
    k = F.col("event_id")
    plain = F.concat_ws(".", F.lit("10"), (k % 256).cast("string"), F.lit("999"), F.lit("1"))
    ip = F.when(k % 10 == 3, F.lit("host.local")).when(k % 10 == 4, F.lit("2001:db8::1")).otherwise(plain)
    rows = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.when(k % 29 != 0, F.lit("a")).alias("ip_address"),
        ip.alias("ip"),
        F.when(k % 8 == 0, "usa").otherwise("US").alias("country"),
        *_times("ts", "event_id"),
        F.date_sub(F.to_date("ts"), F.when(k % 31 == 0, 1).otherwise(0)).alias("event_date"),
    )
    generic = Q.TableRules(required=("ip_address",), addresses=("ip",), countries=("country",)).rules(rows)
    generic = [r for n in ("ip_address_required", "ip_ip_address_format", "country_country_code_format") for r in generic if r.name == n]
    return _reasons(rows, generic + Q.authentication_rules() + Q.date_rules({"event_date": "event_timestamp"}), "event_id")


@query(f"SELECT c_custkey, {_reasons_sql({'updated_at_before_created_at': 'c_custkey % 6 = 0', 'normal_transaction_amount_usd_negative': 'c_acctbal < 0', 'normal_transaction_frequency_per_day_negative': 'c_custkey % 10 = 0'})} FROM customer")
def dq_account_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, at = F.col("c_custkey"), F.lit("2024-01-01").cast("timestamp_ntz")
    rows = read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        at.alias("created_at"),
        F.when(k % 4 != 1, _shifted(at, F.when(k % 6 == 0, -1).otherwise(5))).alias("updated_at"),
        F.col("c_acctbal").alias("normal_transaction_amount_usd"),
        F.when(k % 10 == 0, -0.5).otherwise(1.0).alias("normal_transaction_frequency_per_day"),
    )
    return _reasons(rows, Q.master_rules("accounts"), "c_custkey")


@query(f"SELECT s_suppkey, {_reasons_sql({'last_seen_at_before_first_seen_at': 's_suppkey % 3 = 0'})} FROM supplier")
def dq_device_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        at.alias("first_seen_at"),
        _shifted(at, F.when(F.col("s_suppkey") % 3 == 0, -1).otherwise(0)).alias("last_seen_at"),
    )
    return _reasons(rows, Q.master_rules("devices"), "s_suppkey")


_WALLET_RULES = {
    "wallet_uuid_uuid_format": "p_partkey % 9 = 0",
    "wallet_type_approved_value": "p_size % 7 = 0",
    "supported_assets_approved_values": "p_partkey % 5 = 4",
    "supported_assets_array_size": "p_partkey % 5 IN (0, 3)",
    "supported_assets_unique_items": "p_partkey % 5 = 3",
}


@query(f"SELECT p_partkey, {_reasons_sql(_WALLET_RULES)} FROM part")
def dq_wallet_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallets have generic rules only: format of the id, approved types and assets, number of assets, no asset twice."""
    k = F.col("p_partkey")
    uuid = Ty.uuid5(k.cast("string"))
    some = lambda *xs: F.array(*map(F.lit, xs))
    assets = F.when(
        k % 5 == 0,
        F.array().cast("array<string>"),
    ).when(k % 5 == 3, some("BTC", "ETH", "BTC")).when(k % 5 == 4, some("BTC", "DOGE")).otherwise(some("ETH"))
    rows = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(k % 9 == 0, F.concat(F.lit("x"), uuid)).otherwise(uuid).alias("wallet_uuid"),
        F.when(F.col("p_size") % 7 == 0, "BANK").otherwise("CUSTOMER").alias("wallet_type"),
        assets.alias("supported_assets"),
    )
    rules = Q.TableRules(
        uuids=("wallet_uuid",),
        allowed={"wallet_type": ["CUSTOMER", "EXTERNAL"]},
        allowed_elements={"supported_assets": ["BTC", "ETH"]},
        sizes={"supported_assets": (1, 2)},
        unique_items=("supported_assets",),
    )
    return _reasons(rows, rules.rules(rows), "p_partkey")


_CASCADE_SQL = f"""WITH acc AS (SELECT c_custkey AS id, c_acctbal < 0 AS bad FROM customer),
dev AS (SELECT s_suppkey AS id, list_filter([CASE WHEN p IS NOT NULL AND p NOT IN (SELECT id FROM acc WHERE NOT bad) THEN 'primary_account_not_found' END], lambda x: x IS NOT NULL) AS r FROM (SELECT *, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * 3 END AS p FROM supplier)),
wal AS (SELECT p_partkey AS id, p_size % 2 = 0 AS customer, list_filter([CASE WHEN p IS NOT NULL AND p NOT IN (SELECT id FROM acc WHERE NOT bad) THEN 'owner_account_not_found' END], lambda x: x IS NOT NULL) AS r FROM (SELECT *, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey END AS p FROM part)),
good_w AS (SELECT * FROM wal WHERE len(r) = 0),
tx AS (SELECT *, list_filter([CASE WHEN account_id NOT IN (SELECT id FROM acc WHERE NOT bad) THEN 'account_not_found' END, CASE WHEN device_id NOT IN (SELECT id FROM dev WHERE len(r) = 0) THEN 'device_not_found' END,
 CASE WHEN source_wallet_id IS NOT NULL AND source_wallet_id NOT IN (SELECT id FROM good_w) THEN 'source_wallet_not_found' END, CASE WHEN destination_wallet_id IS NOT NULL AND destination_wallet_id NOT IN (SELECT id FROM good_w) THEN 'destination_wallet_not_found' END,
 CASE WHEN transaction_type = 'DEPOSIT' AND destination_wallet_id IS NOT NULL AND destination_wallet_id NOT IN (SELECT id FROM good_w WHERE customer) THEN 'destination_wallet_not_of_a_customer' END,
 CASE WHEN transaction_type <> 'DEPOSIT' AND source_wallet_id IS NOT NULL AND source_wallet_id NOT IN (SELECT id FROM good_w WHERE customer) THEN 'source_wallet_not_of_a_customer' END], lambda x: x IS NOT NULL) AS r FROM ({_TX_SQL})),
lab AS (SELECT list_filter([CASE WHEN t.transaction_id IS NULL THEN 'transaction_not_found' END, CASE WHEN t.event_timestamp > l.label_timestamp THEN 'label_before_transaction' END], lambda x: x IS NOT NULL) AS r
 FROM (SELECT doc_id * 2 AS transaction_id, TIMESTAMP '1995-01-01' + INTERVAL (doc_id % 900) DAY AS label_timestamp FROM labels) l LEFT JOIN (SELECT * FROM tx WHERE len(r) = 0) t USING (transaction_id))
SELECT name AS table_name, reason, count(*) AS n FROM (SELECT 'devices' AS name, unnest(r) AS reason FROM dev UNION ALL SELECT 'wallets', unnest(r) FROM wal UNION ALL SELECT 'transactions', unnest(r) FROM tx UNION ALL SELECT 'labels', unnest(r) FROM lab) GROUP BY 1, 2"""


@query(_CASCADE_SQL)
def dq_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cross-table rules, from accounts to labels, by table and reason."""
    none = F.array().cast("array<string>")
    t = lambda n: read_table(spark, sf_dir, n)
    accounts = Q.with_reasons(t("customer").select(F.col("c_custkey").alias("account_id"), "c_acctbal"), [Q.Rule("balance", F.col("c_acctbal") < 0)])
    devices = t("supplier").select(
        F.col("s_suppkey").alias("device_id"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey") * 3).alias("primary_account_id"),
        none.alias(Q.REASONS),
    )
    k = F.col("p_partkey")
    wallets = t("part").select(
        k.alias("wallet_id"),
        F.when(k % 4 != 0, k).alias("owner_account_id"),
        F.when(F.col("p_size") % 2 == 0, "CUSTOMER").otherwise("EXTERNAL").alias("wallet_type"),
        none.alias(Q.REASONS),
    )
    at = (F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("doc_id") % 900).cast("int"))).cast("timestamp_ntz")
    labels = t("labels").select((F.col("doc_id") * 2).alias("transaction_id"), at.alias("label_timestamp"), none.alias(Q.REASONS))
    out = Q.cascade({
        "accounts": accounts,
        "devices": devices,
        "wallets": wallets,
        "transactions": _transactions(spark, sf_dir).withColumn(Q.REASONS, none),
        "labels": labels,
    })
    counts = [Q.reason_counts(out[n]).select(F.lit(n).alias("table_name"), "reason", "n") for n in ("devices", "wallets", "transactions", "labels")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


_ORDERS_SCHEMA = "o_orderkey bigint, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_clerk string"


@query("SELECT 'missing_columns' AS check_name, 1 AS failures, 'FAIL' AS status UNION ALL SELECT 'unexpected_columns', 1, 'FAIL' UNION ALL SELECT 'mistyped_columns', 1, 'FAIL' UNION ALL SELECT 'columns_out_of_order', 0, 'PASS' UNION ALL SELECT 'no_rows', (count(*) = 0)::INT, 'PASS' FROM orders")
def dq_schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a contract with a column too many, one too few and one of another type."""
    return Q.schema_checks(read_table(spark, sf_dir, "orders"), T.StructType.fromDDL(_ORDERS_SCHEMA))


@query("SELECT 'o_custkey_unique' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)) AS failures, 'FAIL' AS status UNION ALL SELECT 'o_orderstatus_in_allowed', count(*) FILTER (WHERE o_orderstatus = 'O'), 'FAIL' FROM orders")
def dq_value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return Q.value_checks(rows, ("o_custkey",), {"o_orderstatus": ["F"]})


@query("""SELECT * FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'kept', 'required'), ('status', NULL, 'string', 'added', 'approved_values'), ('o_totalprice', 'double', 'decimal(20,8)', 'converted', 'conversion')) t("column", "from", "to", change, rules)""")
def dq_transformation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    after = rows.select("o_orderkey", F.lit("F").alias("status"), F.col("o_totalprice").cast("decimal(20,8)").alias("o_totalprice"))
    rules = Q.TableRules(required=("o_orderkey",), allowed={"status": ["F"]}, conversions={"o_totalprice": ("raw_price", "decimal")})
    return spark.createDataFrame(
        Q.transformation_matrix(rows.schema, after.schema, rules),
        "column string, from string, to string, change string, rules string",
    )


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'event_id_missing' WHEN 1 THEN 'amount_not_double' WHEN 2 THEN 'zzz_unexpected' WHEN 3 THEN 'not_a_record' ELSE '' END AS problems FROM events")
def dq_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records against a contract: required and optional fields, types, nothing else."""
    k = F.col("event_id")
    body = F.to_json(F.struct(
        F.when(k % 6 != 0, k.cast("string")).alias("event_id"),
        F.when(k % 6 == 1, F.lit("many")).otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(k % 6 == 2, F.lit(1)).alias("zzz"),
        F.when(k % 6 == 5, F.lit("note")).alias("note"),
    ))
    rows = read_table(spark, sf_dir, "events").select("event_id", F.when(k % 6 == 3, F.lit("[1, 2")).otherwise(body).alias("payload"))
    return Q.json_problems(
        rows,
        "payload",
        {"event_id": "bigint", "amount": "double"},
        {"note": "string"},
    ).select("event_id", F.concat_ws(";", "_problems").alias("problems"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN ts WHEN event_id % 4 = 1 THEN ts + INTERVAL 1 SECOND WHEN event_id % 4 = 2 THEN ts + INTERVAL 2 SECOND ELSE ts + INTERVAL 3 SECOND END AS at, (epoch_us(ts)::HUGEINT * 1000)::VARCHAR AS nanos, date_trunc('minute', ts) AS minute, ts - INTERVAL 2 HOUR AS utc FROM events")
def time_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first known time of prediction, event, broker and ingestion; nanoseconds; minutes; local times in UTC."""
    k, ts = F.col("event_id"), F.col("ts")
    when = lambda n: F.when(k % 4 <= n, _shifted(ts, F.lit(n)))
    at = Ty.event_time(*(when(n) for n in range(3)), _shifted(ts, F.lit(3)))
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        at.cast("timestamp_ntz").alias("at"),
        Ty.nanos(ts).cast("string").alias("nanos"),
        Ty.minute_of(ts).alias("minute"),
        Ty.in_utc(ts.cast("timestamp"), "+02:00").cast("timestamp_ntz").alias("utc"),
    )


_SHA1 = "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('transaction:7:' || o_orderkey))"


@query(f"SELECT o_orderkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || lower(printf('%x', (('0x' || h[17:17])::INT & 3) | 8)) || h[18:20] || '-' || h[21:32] AS id FROM (SELECT o_orderkey, {_SHA1} AS h FROM orders)")
def deterministic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name-based UUIDs (version 5) of kind, seed and counter."""
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        Ty.uuid5(F.concat_ws(":", F.lit("transaction"), F.lit("7"), F.col("o_orderkey").cast("string"))).alias("id"),
    )


@query("SELECT event_id, event_id % 5 = 0 AS bad_number, event_id % 6 = 0 AS bad_text, event_id % 7 = 0 AS bad_timestamp, event_id % 3 = 0 OR event_id % 7 = 0 AS key_missing, CASE WHEN event_id % 4 < 2 THEN NULL ELSE value END AS safe FROM events")
def predicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps that can't be read, by type; keys with a null; numbers that JSON can hold."""
    k = F.col("event_id")
    odd = F.when(k % 4 == 0, F.lit(float("nan"))).when(k % 4 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    rows = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.when(k % 10 == 0, F.lit(0)).when(k % 5 != 0, F.lit(9)).cast("bigint").alias("n"),
        F.when(k % 6 == 0, "yesterday").otherwise("2024-01-01 00:00:00").alias("t"),
        F.when(k % 7 != 0, F.col("ts")).alias("at"),
        F.when(k % 3 != 0, k).alias("id"),
        odd.alias("x"),
    )
    return rows.select(
        "event_id",
        P.bad_timestamp(rows, "n").alias("bad_number"),
        P.bad_timestamp(rows, "t").alias("bad_text"),
        P.bad_timestamp(rows, "at").alias("bad_timestamp"),
        P.any_null("id", "at").alias("key_missing"),
        Ty.json_safe(F.col("x")).alias("safe"),
    )


@query("SELECT event_id FROM events WHERE event_id % 9 <> 0 AND event_id % 10 <> 0")
def live_training_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live rows with all nine columns that learning needs."""
    k = F.col("event_id")
    values = {"transaction_id": F.when(k % 9 != 0, k), "is_fraud": F.when(k % 10 != 0, F.lit(True)), "transaction_amount_usd": F.col("value")}
    rows = read_table(spark, sf_dir, "events").select("event_id", *(values.get(c, F.lit("x")).alias(c) for c in P.LIVE_INPUTS))
    return rows.filter(P.all_present(*P.LIVE_INPUTS)).select("event_id")


@query("SELECT * FROM (VALUES ('amount', 'double', false, true, false), ('asset', 'string', false, true, false), ('is_fraud', 'boolean', true, false, true), ('label_timestamp', 'timestamp', true, false, false), ('prior_count', 'bigint', false, true, false)) t(name, dtype, leaks, fits, is_indicator)")
def model_input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that tell of the future, types that a model takes, and names of 0/1 features."""
    rows = spark.createDataFrame([], "amount double, asset string, is_fraud boolean, label_timestamp timestamp, prior_count bigint")
    leaks = P.leaking_columns(rows.columns)
    found = [(c, t, c in leaks, Ty.model_type_fits(t, c == "asset"), P.is_indicator_name(c)) for c, t in rows.dtypes]
    return spark.createDataFrame(found, "name string, dtype string, leaks boolean, fits boolean, is_indicator boolean")


@query("SELECT 100 AS orders_row, 64 + 16 + 8 + 4 + 2 + 1 + 1 + 32 AS mixed_row")
def row_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates of a row's bytes by types."""
    mixed = T.StructType.fromDDL("a string, b decimal(20,8), c bigint, d int, e smallint, f tinyint, g boolean, h array<string>")
    plain = T.StructType.fromDDL("a string, b bigint, c double, d date, e timestamp, f timestamp_ntz")
    return spark.createDataFrame([(row_bytes(plain), row_bytes(mixed))], "orders_row int, mixed_row int")
