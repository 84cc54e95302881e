"""Queries of point-in-time features and market joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.typing import hour_of, seconds
from sluice.operators import features as Fe
from sluice.operators import market as M
from sluice.operators import quality as Q
from sluice.operators.metrics import parity, parity_families
from sluice.operators.scoring import reason_codes
from sluice.sources.tables import read_table

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


SPANS = {"1h": 3600, "24h": 86400, "7d": 604800}
_E = "epoch_us(ts) // 1000000"


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(F.col(c), 6) for c in columns})


@query("SELECT event_id, hour(ts)::INT AS hour_utc, isodow(ts)::INT AS day_of_week_utc, (isodow(ts) >= 6)::INT AS is_weekend_utc, (hour(ts) <= 5)::INT AS is_night_utc FROM events")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Fe.calendar_features(read_table(spark, sf_dir, "events"), "ts").select(
        "event_id",
        "hour_utc",
        "day_of_week_utc",
        "is_weekend_utc",
        "is_night_utc",
    )


def _velocity_sql(e: str, key: str, value: str, idcol: str, source: str, scale: int = 1, out: str = "seconds_since_previous") -> str:
    windows = ", ".join(f"w{n} AS (PARTITION BY k ORDER BY e RANGE BETWEEN {s * scale} PRECEDING AND 1 PRECEDING)" for n, s in SPANS.items())
    cols = ", ".join(f"count(*) OVER w{n} AS prior_count_{n}, round(coalesce(sum(v) OVER w{n}, 0.0), 6) AS prior_sum_{n}" for n in SPANS)
    return f"WITH r AS (SELECT {idcol} AS id, {key} AS k, {value} AS v, {e} AS e FROM {source}) SELECT id, {cols}, round(avg(v) OVER w7d, 6) AS prior_avg_7d, max(v) OVER w7d AS prior_max_7d, (count(*) OVER w7d > 0)::INT AS has_prior_7d, CAST(e - max(e) OVER p AS DOUBLE) AS {out}, (max(e) OVER p IS NOT NULL)::INT AS has_previous FROM r WINDOW {windows}, p AS (PARTITION BY k ORDER BY e RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _velocity(rows: DataFrame, key: str, ts: str, value: str, idcol: str, unit: str = "s") -> DataFrame:
    out = Fe.velocity(rows, key, ts, value, SPANS, unit)
    since = "seconds_since_previous" if unit == "s" else "micros_since_previous"
    cols = [f"prior_{a}_{n}" for n in SPANS for a in ("count", "sum")]
    return _rounded(out, *(f"prior_sum_{n}" for n in SPANS), "prior_avg_7d").select(
        F.col(idcol).alias("id"),
        *cols,
        "prior_avg_7d",
        "prior_max_7d",
        "has_prior_7d",
        F.col(since).cast("double").alias(since),
        "has_previous",
    )


@query(_velocity_sql(_E, "user_id", "value", "event_id", "events"))
def velocity_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _velocity(read_table(spark, sf_dir, "events"), "user_id", "ts", "value", "event_id")


@query(_velocity_sql("epoch_us(ts)", "user_id", "value", "event_id", "events", 1_000_000, "micros_since_previous"))
def velocity_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _velocity(read_table(spark, sf_dir, "events"), "user_id", "ts", "value", "event_id", "us")


@query(_velocity_sql("epoch_us(o_orderdate) // 1000000", "o_custkey", "o_totalprice", "o_orderkey", "orders"))
def velocity_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _velocity(read_table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")


_AUTH_SQL = f"""
WITH t AS (SELECT event_id, user_id, {_E} AS e, event_type = 'purchase' AS subject, event_type = 'signup' AS success FROM events WHERE event_type IN ('purchase', 'signup', 'error')),
w AS (SELECT *, count(*) FILTER (WHERE NOT subject AND NOT success) OVER s AS failed_auth_short, count(*) FILTER (WHERE NOT subject AND NOT success) OVER l AS failed_auth_long,
 count(*) FILTER (WHERE NOT subject AND success) OVER l AS successful_auth_long, max(CASE WHEN NOT subject AND success THEN e END) OVER p AS last FROM t
 WINDOW s AS (PARTITION BY user_id ORDER BY e RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), l AS (PARTITION BY user_id ORDER BY e RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING), p AS (PARTITION BY user_id ORDER BY e RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, failed_auth_short, failed_auth_long, successful_auth_long, (failed_auth_short > 0)::INT AS recent_auth_failure, CAST(e - last AS DOUBLE) AS seconds_since_last_success, (last IS NOT NULL)::INT AS has_previous_success FROM w WHERE subject"""


def _auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    logins = e.filter(F.col("event_type").isin("signup", "error")).withColumn("success", F.col("event_type") == "signup")
    out = Fe.authentication_features(e.filter("event_type = 'purchase'"), logins, "user_id", "ts", "success", 86400, 604800)
    return out.withColumn("seconds_since_last_success", F.col("seconds_since_last_success").cast("double"))


@query(_AUTH_SQL)
def auth_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _auth(spark, sf_dir).select(
        "event_id",
        "failed_auth_short",
        "failed_auth_long",
        "successful_auth_long",
        "recent_auth_failure",
        "seconds_since_last_success",
        "has_previous_success",
    )


@query(f"SELECT event_id, count(*) OVER w AS prior_events, count(DISTINCT user_id) OVER w AS distinct_accounts FROM (SELECT event_id, user_id, json_extract_string(props, '$.k') AS k, {_E} AS e FROM events) WINDOW w AS (PARTITION BY k ORDER BY e RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)")
def device_shared_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return Fe.shared_entity(rows, "k", "ts", "user_id", 86400).select("event_id", "prior_events", "distinct_accounts")


@query("""
WITH r AS (SELECT DISTINCT l_orderkey, l_suppkey, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS s, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_suppkey, CASE WHEN s IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY s ORDER BY epoch_us(o_orderdate) // 1000000 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS prior_wallet_count,
 CAST(CASE WHEN s IS NULL THEN NULL WHEN count(*) OVER (PARTITION BY s ORDER BY epoch_us(o_orderdate) // 1000000 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0 THEN 1 ELSE 0 END AS DOUBLE) AS is_new_wallet, (s IS NOT NULL)::INT AS wallet_applicable FROM r""")
def wallet_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    rows = lines.join(read_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select("l_orderkey", "l_suppkey", F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("s"), "o_orderdate")
    return Fe.counterparty_history(rows, "s", "o_orderdate", "wallet").select(
        "l_orderkey",
        "l_suppkey",
        "prior_wallet_count",
        F.col("is_new_wallet").cast("double").alias("is_new_wallet"),
        "wallet_applicable",
    )


_PROFILE = "SELECT c_custkey, TIMESTAMP '2024-01-01' + INTERVAL (c_custkey % 30) DAY AS created_at, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2024-01-02' + INTERVAL (c_custkey % 40) DAY END AS updated_at, c_mktsegment AS risk_tier, c_acctbal AS normal_amount, c_nationkey % 5 AS home_country FROM customer"


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda start, n: (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(n.cast("int"))).cast("timestamp_ntz")
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        k.alias("user_id"),
        day("2024-01-01", k % 30).alias("created_at"),
        F.when(k % 5 != 0, day("2024-01-02", k % 40)).alias("updated_at"),
        F.col("c_mktsegment").alias("risk_tier"),
        F.col("c_acctbal").alias("normal_amount"),
        (F.col("c_nationkey") % 5).alias("home_country"),
    )


_PROFILE_SQL = f"""
SELECT event_id, CAST(CASE WHEN created_at <= t THEN floor((epoch(t) - epoch(created_at)) / 86400) END AS DOUBLE) AS account_age_days, ok::INT AS account_profile_available, CASE WHEN ok THEN risk_tier END AS customer_risk_tier,
 CASE WHEN ok THEN normal_amount END AS normal_transaction_amount_usd, coalesce(ok AND normal_amount > 0, false)::INT AS normal_transaction_amount_available,
 round(CASE WHEN ok AND normal_amount > 0 THEN value / normal_amount END, 6) AS amount_to_normal_ratio, round(CASE WHEN ok AND normal_amount > 0 THEN value - normal_amount END, 6) AS amount_above_normal_usd,
 CAST(CASE WHEN ok THEN (country <> home_country)::INT END AS DOUBLE) AS country_mismatch
FROM (SELECT e.*, p.*, coalesce(created_at <= t AND (updated_at IS NULL OR updated_at <= t), false) AS ok FROM (SELECT *, date_trunc('second', ts) AS t, event_id % 5 AS country FROM events) e LEFT JOIN ({_PROFILE}) p ON p.c_custkey = e.user_id)"""


@query(_PROFILE_SQL)
def profile_gating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("country", F.col("event_id") % 5)
    out = Fe.profile_features(rows, _profiles(spark, sf_dir), "user_id", "ts", "value")
    out = _rounded(
        out,
        "amount_to_normal_ratio",
        "amount_above_normal_usd",
    ).withColumns({c: F.col(c).cast("double") for c in ("account_age_days", "country_mismatch")})
    return out.drop("ts", "user_id", "event_type", "value", "props", "country")


@query(f"""
WITH p AS ({_PROFILE}) SELECT event_id, coalesce(created_at <= t, false)::INT AS device_profile_available, round(CASE WHEN created_at <= t THEN (epoch(t) - epoch(created_at)) / 3600 END, 4) AS device_age_hours,
 round(CASE WHEN created_at <= t THEN (epoch(t) - epoch(created_at)) / 3600 / 24 END, 3) AS device_age_days, CAST(CASE WHEN created_at <= t THEN ((epoch(t) - epoch(created_at)) / 3600 <= 24)::INT END AS DOUBLE) AS is_new_device_24h
FROM (SELECT *, date_trunc('second', ts) AS t FROM events) LEFT JOIN p ON c_custkey = user_id""")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _profiles(spark, sf_dir).select("user_id", F.col("created_at").alias("first_seen_at"))
    out = Fe.first_seen_features(read_table(spark, sf_dir, "events"), seen, "user_id", "ts", "device")
    return out.select(
        "event_id",
        "device_profile_available",
        F.round("device_age_hours", 4).alias("device_age_hours"),
        F.round("device_age_days", 3).alias("device_age_days"),
        F.col("is_new_device_24h").cast("double").alias("is_new_device_24h"),
    )


_CANDLES = "SELECT event_type AS product, date_trunc('hour', ts) AS candle_start, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, count(*) AS n_trades, date_trunc('hour', ts) + INTERVAL 1 HOUR AS candle_end FROM events GROUP BY 1, 2"


def _candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.candles(read_table(spark, sf_dir, "events"), "event_type", "ts", "value", "event_id")


@query(f"SELECT product, candle_start, open, high, low, close, round(volume, 6) AS volume, n_trades, candle_end FROM ({_CANDLES})")
def market_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_candles(spark, sf_dir), "volume")


_STATE = f"""
SELECT product, candle_end, close, log_return, CASE WHEN b1 > 0 THEN close / b1 - 1 END AS return_short, CASE WHEN b2 > 0 THEN close / b2 - 1 END AS return_long, stddev_samp(log_return) OVER n AS volatility, sum(volume) OVER n AS volume_sum FROM (
 SELECT *, epoch_us(candle_end) // 1000000 AS e, CASE WHEN lag(close) OVER l > 0 AND close > 0 THEN ln(close / lag(close) OVER l) END AS log_return,
  last_value(close) OVER (PARTITION BY product ORDER BY epoch_us(candle_end) // 1000000 RANGE BETWEEN UNBOUNDED PRECEDING AND 7200 PRECEDING) AS b1,
  last_value(close) OVER (PARTITION BY product ORDER BY epoch_us(candle_end) // 1000000 RANGE BETWEEN UNBOUNDED PRECEDING AND 86400 PRECEDING) AS b2 FROM ({_CANDLES}) WINDOW l AS (PARTITION BY product ORDER BY candle_end))
WINDOW n AS (PARTITION BY product ORDER BY e RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.market_state(_candles(spark, sf_dir), 7200, 86400, 86400)


@query(f"SELECT product, candle_end, round(log_return, 6) AS log_return, round(return_short, 6) AS return_short, round(return_long, 6) AS return_long FROM ({_STATE})")
def market_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        _states(spark, sf_dir).select("product", "candle_end", "log_return", "return_short", "return_long"),
        "log_return",
        "return_short",
        "return_long",
    )


@query(f"SELECT product, candle_end, round(volatility, 6) AS volatility, round(volume_sum, 6) AS volume_sum FROM ({_STATE})")
def market_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_states(spark, sf_dir).select("product", "candle_end", "volatility", "volume_sum"), "volatility", "volume_sum")


@query(f"SELECT e.event_id, c.candle_end AS state_at, c.close, CAST(epoch_us(e.ts) // 1000000 - epoch_us(c.candle_end) // 1000000 AS DOUBLE) AS freshness_seconds, (c.close IS NOT NULL)::INT AS market_data_available FROM events e ASOF LEFT JOIN ({_CANDLES}) c ON e.event_type = c.product AND e.ts >= c.candle_end")
def asof_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.as_of(read_table(spark, sf_dir, "events"), _candles(spark, sf_dir), "event_type", "ts", "product", "candle_end", ["close"])
    return out.select("event_id", "state_at", "close", F.col("freshness_seconds").cast("double").alias("freshness_seconds"), "market_data_available")


@query(f"WITH g AS (SELECT product, unnest(generate_series(min(candle_start), max(candle_start), INTERVAL 1 HOUR)) AS candle_start FROM ({_CANDLES}) GROUP BY product) SELECT product, candle_start FROM g WHERE NOT EXISTS (SELECT 1 FROM ({_CANDLES}) c WHERE c.product = g.product AND c.candle_start = g.candle_start)")
def gap_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gaps(_candles(spark, sf_dir).select("product", "candle_start"), "product", "candle_start", "1 hour")


FEATURES = [
    "prior_count_1h",
    "prior_sum_24h",
    "prior_count_7d",
    "failed_auth_long",
    "successful_auth_long",
    "amount_to_normal_ratio",
    "country_mismatch",
    "is_new_device_24h",
    "distinct_accounts",
    "close",
    "volatility",
]
_FEATURE_SQL = f"""
WITH v AS ({_velocity_sql(_E, "user_id", "value", "event_id", "events")}), a AS ({_AUTH_SQL}), p AS ({_PROFILE_SQL}),
d AS ({ORACLES["first_seen"]}), s AS ({ORACLES["device_shared_accounts"]}), c AS ({_STATE}),
m AS (SELECT e.event_id, c.close, c.volatility FROM events e ASOF LEFT JOIN c ON e.event_type = c.product AND e.ts >= c.candle_end)
SELECT a.event_id, prior_count_1h, prior_sum_24h, prior_count_7d, failed_auth_long, successful_auth_long, amount_to_normal_ratio, country_mismatch, is_new_device_24h, distinct_accounts, close, round(volatility, 6) AS volatility
FROM a JOIN v ON v.id = a.event_id JOIN p USING (event_id) JOIN d USING (event_id) JOIN s USING (event_id) JOIN m USING (event_id)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of purchases: one window stage for users, one for devices, one for products, and joins on small tables."""
    e = read_table(spark, sf_dir, "events")
    rows = Fe.velocity(e, "user_id", "ts", "value", SPANS)
    logins = rows.filter(F.col("event_type").isin("signup", "error")).withColumn("success", F.col("event_type") == "signup")
    rows = Fe.shared_entity(rows.withColumn("k", F.get_json_object("props", "$.k")), "k", "ts", "user_id", 86400)
    rows = Fe.authentication_features(
        rows.filter("event_type = 'purchase'"),
        logins.select("user_id", "ts", "success"),
        "user_id",
        "ts",
        "success",
        86400,
        604800,
    )
    profiles = _profiles(spark, sf_dir)
    rows = Fe.profile_features(rows.withColumn("country", F.col("event_id") % 5), profiles, "user_id", "ts", "value")
    rows = Fe.first_seen_features(rows, profiles.select("user_id", F.col("created_at").alias("first_seen_at")), "user_id", "ts", "device")
    rows = M.as_of(rows, _states(spark, sf_dir), "event_type", "ts", "product", "candle_end", ["close", "volatility"])
    rows = _rounded(rows, "prior_sum_24h", "amount_to_normal_ratio", "volatility")
    return rows.withColumns({c: F.col(c).cast("double") for c in ("country_mismatch", "is_new_device_24h")})


@query(_FEATURE_SQL)
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("event_id", *FEATURES)


@query(f"SELECT a.event_id, count(b.event_id) AS prior_pairs, count(b.event_id) AS window_count, true AS equal FROM (SELECT *, {_E} AS e FROM events) a LEFT JOIN (SELECT *, {_E} AS e FROM events) b ON a.user_id = b.user_id AND b.e >= a.e - 86400 AND b.e < a.e GROUP BY a.event_id")
def leakage_selfjoin_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts against a range join that looks at prior rows one by one."""
    rows = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("_row"), "user_id", "ts", "value")
    w = Fe.velocity(rows, "user_id", "ts", "value", {"24h": 86400}).select("_row", F.col("prior_count_24h").alias("window_count"))
    pairs = Fe.prior_pairs(rows, "user_id", "ts", 86400)
    return pairs.join(w, "_row").select(
        F.col("_row").alias("event_id"),
        "prior_pairs",
        "window_count",
        (F.col("prior_pairs") == F.col("window_count")).alias("equal"),
    )


_REASONS = {
    "NEW_DEVICE": "is_new_device_24h >= 1",
    "NEW_COUNTRY": "country_mismatch >= 1",
    "HIGH_TRANSACTION_VELOCITY": "prior_count_1h >= 3",
    "UNUSUAL_AMOUNT": "amount_to_normal_ratio >= 4.0",
    "HIGH_MARKET_VOLATILITY": "volatility >= 0.02",
    "SUSPICIOUS_SHARED_DEVICE": "distinct_accounts >= 3",
}


@query(f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat_ws(';', {', '.join(f'CASE WHEN {c} THEN {k!r} END' for k, c in _REASONS.items())}) ELSE '' END AS reasons FROM ({_FEATURE_SQL})")
def reason_code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feature_table(spark, sf_dir)
    return rows.select("event_id", F.concat_ws(";", reason_codes(F.col("event_id") % 3 == 0, rows.columns)).alias("reasons"))


_PARITY_SQL = f"""
SELECT f AS feature, count(*) FILTER (WHERE k <> 0 AND m > 1) AS exact, 0::BIGINT AS tolerance, count(*) FILTER (WHERE k = 0 OR m <= 1) AS mismatch,
 count(*) FILTER (WHERE m = 0) AS left_only, count(*) FILTER (WHERE m = 1) AS right_only
FROM (SELECT unnest(['prior_count_1h', 'prior_sum_24h']) AS f, event_id % 50 AS k, event_id % 70 AS m FROM ({_FEATURE_SQL})) GROUP BY f"""


def _parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table against a copy that is off in some rows and lacks others; it lacks some of the copy's, too."""
    names, k = ["prior_count_1h", "prior_sum_24h"], F.col("event_id")
    rows = feature_table(spark, sf_dir).select("event_id", *names)
    other = rows.filter(k % 70 != 0).select("event_id", *(F.when(k % 50 == 0, F.col(c) + 1).otherwise(F.col(c)).alias(c) for c in names))
    return parity(rows.filter(k % 70 != 1), other, "event_id", names)


@query(_PARITY_SQL)
def parity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parity(spark, sf_dir).select("feature", "exact", "tolerance", "mismatch", "left_only", "right_only")


@query("SELECT * FROM (VALUES ('prior_count_1h', 'history', 'MAJOR-MISMATCH'), ('prior_sum_24h', 'history', 'MAJOR-MISMATCH'), ('close', 'market', 'NOT-VERIFIABLE')) t(feature, family, static_status)")
def parity_by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What parity tells of each family's features; nothing was compared of the market's."""
    return parity_families(_parity(spark, sf_dir), {"history": ["prior_count_1h", "prior_sum_24h"], "market": ["close"]})


@query("SELECT count(*) AS n, sum(price_usd * size)::DOUBLE AS turnover FROM (SELECT CAST(value AS DECIMAL(20,8)) AS price_usd, CAST(event_id AS DECIMAL(20,8)) AS size FROM events WHERE value > 0 AND event_id > 0)")
def market_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    trade = F.struct(
        F.col("event_id").cast("string").alias("trade_id"),
        F.lit("BTC-USD").alias("product_id"),
        F.col("value").cast("string").alias("price"),
        F.col("event_id").cast("string").alias("size"),
        F.lit("buy").alias("side"),
        F.lit("2024-01-01T00:00:00.123456Z").alias("time"),
    )
    message = F.to_json(F.struct(
        F.lit("market_trades").alias("channel"),
        F.col("event_id").alias("sequence_num"),
        F.array(F.struct(F.lit("update").alias("type"), F.array(trade).alias("trades"))).alias("events"),
    ))
    rows = M.trade_rows(read_table(spark, sf_dir, "events").select(message.alias("m")), "m")
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("price_usd") * F.col("size")).cast("double").alias("turnover"))


@query(f"SELECT event_type AS product_id, make_timestamp(({_E}) * 1000000) AS candle_start, value AS open, round(value + 1, 6) AS high FROM events WHERE {_E} >= 1704067200 AND {_E} < 1706745600 QUALIFY row_number() OVER (PARTITION BY event_type, {_E} ORDER BY event_id DESC) = 1")
def candle_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").select(
        "event_type",
        "event_id",
        F.array(seconds(F.col("ts")).cast("double"), F.col("value") - 1, F.col("value") + 1, F.col("value"), F.col("value"), F.lit(1.0)).alias("a"),
    )
    out = M.candle_rows(rows, "a", "event_type", 1704067200, 1706745600, "event_id")  # the whole of January, in the order of ids
    return out.select(
        "product_id",
        F.col("candle_start").cast("timestamp_ntz").alias("candle_start"),
        F.col("open").cast("double").alias("open"),
        F.round(F.col("high").cast("double"), 6).alias("high"),
    )


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").groupBy(hour_of(F.col("ts")).alias("hour")).agg(F.count("*").alias("n"))


@query(f"SELECT a.event_id AS subject_id, b.event_id, (a.e - b.e)::BIGINT AS age_seconds FROM (SELECT *, {_E} AS e FROM events WHERE event_type = 'error') a JOIN (SELECT *, {_E} AS e FROM events) b ON a.user_id = b.user_id AND b.e < a.e AND b.e >= a.e - 604800 QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.ts DESC, b.event_id DESC) <= 20")
def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events")
    return Fe.evidence(rows, "user_id", "ts", "event_id", F.col("event_type") == "error", 604800).select("subject_id", "event_id", "age_seconds")


# All inputs of the models.  Purchases are transactions, signups and errors logins that succeed and fail, the key of the
# properties is the device.  Time runs a hundred times as fast, so that windows of minutes and hours hold something.
_FAST = "1704067200 + (epoch_us(ts) // 1000000 - 1704067200) // 100"
_INPUT_SQL = f"""
WITH e AS (SELECT *, {_FAST} AS t, json_extract_string(props, '$.k') AS k FROM events),
tx AS (SELECT event_id AS transaction_id, user_id AS account_id, k AS device_id, t, make_timestamp(t * 1000000) AS ts, CASE WHEN event_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS asset,
 CASE event_id % 3 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL' ELSE 'TRANSFER' END AS transaction_type, CASE WHEN event_id % 3 <> 0 THEN user_id % 50 END AS source_wallet_id, CASE WHEN event_id % 11 <> 0 THEN event_id % 40 END AS destination_wallet_id,
 event_id % 5 AS country, value AS transaction_amount_usd, value / 10 AS crypto_quantity, 10.0::DOUBLE AS market_price_usd FROM e WHERE event_type = 'purchase'),
lg AS (SELECT user_id AS account_id, k AS device_id, t, event_type = 'signup' AS ok FROM e WHERE event_type IN ('signup', 'error')),
h AS (SELECT transaction_id, count(*) OVER a AS prior_tx_count_5m, count(*) OVER b AS prior_tx_count_1h, count(*) OVER c AS prior_tx_count_24h, coalesce(sum(transaction_amount_usd) OVER b, 0) AS prior_tx_amount_sum_1h, coalesce(sum(transaction_amount_usd) OVER c, 0) AS prior_tx_amount_sum_24h,
 avg(transaction_amount_usd) OVER c AS prior_tx_amount_avg_24h, max(transaction_amount_usd) OVER c AS prior_tx_amount_max_24h, (count(*) OVER c > 0)::INT AS has_prior_tx_24h, t - max(t) OVER p AS seconds_since_previous_tx, (max(t) OVER p IS NOT NULL)::INT AS has_previous_transaction FROM tx
 WINDOW a AS (PARTITION BY account_id ORDER BY t RANGE BETWEEN 300 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY account_id ORDER BY t RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING), c AS (PARTITION BY account_id ORDER BY t RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING), p AS (PARTITION BY account_id ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
au AS (SELECT x.transaction_id, count(*) FILTER (WHERE NOT ok AND l.t >= x.t - 600) AS failed_auth_count_10m, count(*) FILTER (WHERE NOT ok AND l.t >= x.t - 3600) AS failed_auth_count_1h, count(*) FILTER (WHERE ok AND l.t >= x.t - 3600) AS successful_auth_count_1h, min(x.t) - max(l.t) FILTER (WHERE ok) AS seconds_since_last_successful_auth
 FROM tx x LEFT JOIN lg l ON l.account_id = x.account_id AND l.t < x.t GROUP BY 1),
dv AS (SELECT x.transaction_id, count(*) FILTER (WHERE NOT ok AND l.t >= x.t - 600) AS device_failed_auth_count_10m, count(*) FILTER (WHERE ok) AS device_successful_auth_count_1h, count(DISTINCT l.account_id) AS device_distinct_account_count_1h FROM tx x LEFT JOIN lg l ON l.device_id = x.device_id AND l.t < x.t AND l.t >= x.t - 3600 GROUP BY 1),
wl AS (SELECT transaction_id, CASE WHEN destination_wallet_id IS NOT NULL THEN count(*) OVER (PARTITION BY destination_wallet_id ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 0 END AS prior_destination_wallet_tx_count, CASE WHEN source_wallet_id IS NOT NULL THEN count(*) OVER (PARTITION BY source_wallet_id ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 0 END AS prior_source_wallet_tx_count FROM tx),
ac AS (SELECT c_custkey, 1704067200 + (c_custkey % 30) * 600 AS created, CASE WHEN c_custkey % 5 <> 0 THEN 1704067200 + (c_custkey % 30) * 600 + (c_custkey % 40) * 300 END AS updated, c_mktsegment, c_acctbal, c_nationkey % 5 AS home FROM customer),
cd AS (SELECT event_type AS product, t // 60 * 60 + 60 AS candle_end, arg_max(value, (t, event_id)) AS close, sum(value) AS volume FROM e GROUP BY 1, 2),
st0 AS (SELECT *, ln(close / lag(close) OVER (PARTITION BY product ORDER BY candle_end)) AS lr, last_value(close) OVER (PARTITION BY product ORDER BY candle_end RANGE BETWEEN UNBOUNDED PRECEDING AND 300 PRECEDING) AS b5, last_value(close) OVER (PARTITION BY product ORDER BY candle_end RANGE BETWEEN UNBOUNDED PRECEDING AND 3600 PRECEDING) AS b60 FROM cd),
st AS (SELECT product, candle_end, close, close / b5 - 1 AS r5, close / b60 - 1 AS r60, stddev_samp(lr) OVER w AS vol, sum(volume) OVER w AS vs FROM st0 WINDOW w AS (PARTITION BY product ORDER BY candle_end RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)),
mk AS (SELECT x.transaction_id, x.t - s.candle_end AS market_data_freshness_seconds, s.* FROM (SELECT *, CASE asset WHEN 'BTC' THEN 'purchase' ELSE 'view' END AS p FROM tx) x ASOF LEFT JOIN st s ON x.p = s.product AND x.t >= s.candle_end),
dt AS (SELECT *, 1704067200 + (device_id::INT % 20) * 900 AS df, 1704067200 + (destination_wallet_id % 30) * 600 AS wf FROM tx)
SELECT x.transaction_id, x.asset, x.transaction_type, x.country, x.transaction_amount_usd, x.crypto_quantity, x.market_price_usd, hour(x.ts) AS transaction_hour_utc, isodow(x.ts) AS transaction_day_of_week_utc, (isodow(x.ts) >= 6)::INT AS is_weekend_utc, (hour(x.ts) <= 5)::INT AS is_night_transaction_utc,
 CASE WHEN created <= x.t THEN (x.t - created) // 86400 END AS account_age_days, coalesce(ok, false)::INT AS account_profile_available, CASE WHEN ok THEN c_mktsegment END AS customer_risk_tier, CASE WHEN ok THEN c_acctbal END AS normal_transaction_amount_usd, coalesce(ok AND c_acctbal > 0, false)::INT AS normal_transaction_amount_available,
 round(CASE WHEN ok AND c_acctbal > 0 THEN x.transaction_amount_usd / c_acctbal END, 6) AS amount_to_normal_ratio, round(CASE WHEN ok AND c_acctbal > 0 THEN x.transaction_amount_usd - c_acctbal END, 6) AS amount_above_normal_usd, CASE WHEN ok THEN (x.country <> home)::INT END AS transaction_country_mismatch_home_country,
 prior_tx_count_5m, prior_tx_count_1h, prior_tx_count_24h, round(prior_tx_amount_sum_1h, 6) AS prior_tx_amount_sum_1h, round(prior_tx_amount_sum_24h, 6) AS prior_tx_amount_sum_24h, round(prior_tx_amount_avg_24h, 6) AS prior_tx_amount_avg_24h, prior_tx_amount_max_24h, has_prior_tx_24h, seconds_since_previous_tx, has_previous_transaction,
 failed_auth_count_10m, failed_auth_count_1h, successful_auth_count_1h, (failed_auth_count_10m > 0)::INT AS recent_auth_failure_flag_10m, seconds_since_last_successful_auth, (seconds_since_last_successful_auth IS NOT NULL)::INT AS has_previous_successful_auth, device_failed_auth_count_10m, device_successful_auth_count_1h, device_distinct_account_count_1h,
 (df <= x.t)::INT AS device_profile_available, round(CASE WHEN df <= x.t THEN (x.t - df) / 3600 END, 4) AS device_age_hours, round(CASE WHEN df <= x.t THEN (x.t - df) / 3600 / 24 END, 3) AS device_age_days, CASE WHEN df <= x.t THEN ((x.t - df) / 3600 <= 24)::INT END AS is_new_device_24h,
 (x.source_wallet_id IS NOT NULL)::INT AS source_wallet_applicable, (x.destination_wallet_id IS NOT NULL)::INT AS destination_wallet_applicable, coalesce(wf <= x.t, false)::INT AS destination_wallet_first_seen_available, round(CASE WHEN wf <= x.t THEN (x.t - wf) / 3600 END, 4) AS destination_wallet_age_hours,
 CASE WHEN x.destination_wallet_id IS NOT NULL THEN (prior_destination_wallet_tx_count = 0)::INT END AS is_new_destination_wallet, prior_destination_wallet_tx_count, prior_source_wallet_tx_count,
 market_data_freshness_seconds, close AS latest_market_close_usd, round(r5, 6) AS market_return_5m, round(r60, 6) AS market_return_1h, round(vol, 6) AS market_volatility_1h, round(vs, 6) AS market_volume_sum_1h, (close IS NOT NULL)::INT AS market_data_available
FROM dt x JOIN h USING (transaction_id) JOIN au USING (transaction_id) JOIN dv USING (transaction_id) JOIN wl USING (transaction_id) JOIN mk USING (transaction_id)
LEFT JOIN (SELECT transaction_id, ac.*, created <= t AND (updated IS NULL OR updated <= t) AS ok FROM tx JOIN ac ON c_custkey = account_id) p USING (transaction_id)"""
_ROUNDED = {
    3: ("device_age_days",),
    4: ("device_age_hours", "destination_wallet_age_hours"),
    6: (
        "amount_to_normal_ratio",
        "amount_above_normal_usd",
        "prior_tx_amount_sum_1h",
        "prior_tx_amount_sum_24h",
        "prior_tx_amount_avg_24h",
        "market_return_5m",
        "market_return_1h",
        "market_volatility_1h",
        "market_volume_sum_1h",
    ),
}


def input_tables(spark: SparkSession, sf_dir: str) -> dict:
    """The tables that the inputs are made from."""
    base = 1704067200
    at = lambda s: F.timestamp_seconds(s)
    e = read_table(spark, sf_dir, "events").withColumn(
        "feature_timestamp",
        at(base + F.floor((seconds(F.col("ts")) - base) / 100)),
    ).withColumn("k", F.get_json_object("props", "$.k"))
    i = F.col("event_id")
    kind = F.when(i % 3 == 0, "DEPOSIT").when(i % 3 == 1, "WITHDRAWAL").otherwise("TRANSFER")
    tx = e.filter("event_type = 'purchase'").select(
        i.alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("k").alias("device_id"),
        F.when(i % 3 != 0, F.col("user_id") % 50).alias("source_wallet_id"),
        F.when(i % 11 != 0, i % 40).alias("destination_wallet_id"),
        "feature_timestamp",
        F.when(i % 2 == 0, "BTC").otherwise("ETH").alias("asset"),
        kind.alias("transaction_type"),
        (i % 5).alias("country"),
        F.col("value").alias("transaction_amount_usd"),
        (F.col("value") / 10).alias("crypto_quantity"),
        F.lit(10.0).alias("market_price_usd"),
    )
    logins = e.filter(F.col("event_type").isin("signup", "error")).select(
        F.col("user_id").alias("account_id"),
        F.col("k").alias("device_id"),
        "feature_timestamp",
        (F.col("event_type") == "signup").alias("login_success"),
    )
    c = F.col("c_custkey")
    created = base + c % 30 * 600
    accounts = read_table(spark, sf_dir, "customer").select(
        c.alias("account_id"),
        at(created).alias("created_at"),
        F.when(c % 5 != 0, at(created + c % 40 * 300)).alias("updated_at"),
        F.col("c_mktsegment").alias("risk_tier"),
        F.col("c_acctbal").alias("normal_amount"),
        (F.col("c_nationkey") % 5).alias("home_country"),
    )
    devices = spark.range(100).select(F.col("id").cast("string").alias("device_id"), at(base + F.col("id") % 20 * 900).alias("first_seen_at"))
    wallets = spark.range(40).select(F.col("id").alias("wallet_id"), at(base + F.col("id") % 30 * 600).alias("first_seen_at"))
    candles = M.candles(e, "event_type", "feature_timestamp", "value", "event_id", "minute")
    return {
        "transactions": tx,
        "accounts": accounts,
        "devices": devices,
        "wallets": wallets,
        "logins": logins,
        "states": M.market_state(candles, 300, 3600, 3600),
        "products": {"BTC": "purchase", "ETH": "view"},
    }


#: Whole numbers that may be null, as doubles for comparing.
_NULLABLE = (
    "account_age_days",
    "transaction_country_mismatch_home_country",
    "seconds_since_previous_tx",
    "seconds_since_last_successful_auth",
    "is_new_device_24h",
    "is_new_destination_wallet",
    "market_data_freshness_seconds",
)


@query(f"SELECT * REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in _NULLABLE)}) FROM ({_INPUT_SQL})")
def model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 55 inputs of the models, of every transaction."""
    rows = Fe.feature_rows(**input_tables(spark, sf_dir))
    rows = rows.withColumns({c: F.round(c, n) for n, cs in _ROUNDED.items() for c in cs} | {c: F.col(c).cast("double") for c in _NULLABLE})
    return rows.select("transaction_id", *(c for family in Fe.MODEL_INPUTS.values() for c in family))
