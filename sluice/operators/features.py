"""Point-in-time features.  An event counts as prior only if it is strictly earlier.

All windows of one entity share one partitioning and order, so each entity is
one exchange and one sort however many columns it gives.  Times are whole
seconds by default; `unit="us"` works in microseconds, as online scoring does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.typing import flag, iso_weekday, micros, seconds

HOUR, DAY = 3600, 86400


def epoch(ts: str, unit: str = "s") -> Column:
    """The order key of windows."""
    return {"s": seconds, "us": micros}[unit](F.col(ts))


def before(key: str, order: str, span: int | None, unit: str = "s", inclusive: bool = False):
    """Rows of a key in [t - span, t), at the unit's resolution; all earlier ones without a span."""
    scale = {"s": 1, "us": 1_000_000}[unit]
    low = Window.unboundedPreceding if span is None else -span * scale
    return Window.partitionBy(key).orderBy(order).rangeBetween(low, 0 if inclusive else -1)


def calendar_features(rows: DataFrame, ts: str) -> DataFrame:
    """Hour, ISO weekday, weekend and night (0 to 5) flags, in UTC."""
    hour, day = F.hour(ts), iso_weekday(F.col(ts))
    return rows.select(
        "*",
        hour.cast("int").alias("hour_utc"),
        day.cast("int").alias("day_of_week_utc"),
        flag(day >= 6).alias("is_weekend_utc"),
        flag(hour <= 5).alias("is_night_utc"),
    )


def velocity(rows: DataFrame, key: str, ts: str, amount: str, spans: dict[str, int], unit: str = "s") -> DataFrame:
    """Prior counts and sums for each span, average and maximum for the longest, and the time since the previous event."""
    e = rows.withColumn("_e", epoch(ts, unit))
    longest = max(spans, key=spans.get)
    columns = []
    for name, span in spans.items():
        w = before(key, "_e", span, unit)
        columns += [F.count(F.lit(1)).over(w).alias(f"prior_count_{name}"), F.coalesce(F.sum(amount).over(w), F.lit(0.0)).alias(f"prior_sum_{name}")]
    w = before(key, "_e", spans[longest], unit)
    last = F.max("_e").over(before(key, "_e", None, unit))
    columns += [F.avg(amount).over(w).alias(f"prior_avg_{longest}"), F.max(amount).over(w).alias(f"prior_max_{longest}"), last.alias("_last")]
    return e.select("*", *columns).select(
        *rows.columns,
        *(c for name in spans for c in (f"prior_count_{name}", f"prior_sum_{name}")),
        f"prior_avg_{longest}",
        f"prior_max_{longest}",
        flag(F.col(f"prior_count_{longest}") > 0).alias(f"has_prior_{longest}"),
        (F.col("_e") - F.col("_last")).alias("seconds_since_previous" if unit == "s" else "micros_since_previous"),
        flag(F.col("_last").isNotNull()).alias("has_previous"),
    )


def timeline(subjects: DataFrame, others: DataFrame, key: str, ts: str, extra: list[str]) -> DataFrame:
    """Both kinds of events of an entity in one frame; _subject tells which; columns a side lacks are null."""
    left = subjects.withColumn("_subject", F.lit(True))
    right = others.select(key, ts, *extra).withColumn("_subject", F.lit(False))
    return left.unionByName(right, allowMissingColumns=True)


def authentication_features(subjects: DataFrame, logins: DataFrame, key: str, ts: str, success: str, short: int = 600, long: int = HOUR) -> DataFrame:
    """For each subject: prior failed logins (short, long), successful ones (long), and the time since the last success."""
    rows = timeline(subjects, logins, key, ts, [success]).withColumn("_e", epoch(ts))
    near, far, ever = (before(key, "_e", s) for s in (short, long, None))
    failed, good = F.when(~F.col("_subject") & ~F.col(success), 1), F.when(~F.col("_subject") & F.col(success), 1)
    last = F.max(F.when(good.isNotNull(), F.col("_e"))).over(ever)
    out = rows.select(
        "*",
        F.count(failed).over(near).alias("failed_auth_short"),
        F.count(failed).over(far).alias("failed_auth_long"),
        F.count(good).over(far).alias("successful_auth_long"),
        last.alias("_last"),
    )
    return out.filter("_subject").select(
        *subjects.columns,
        "failed_auth_short",
        "failed_auth_long",
        "successful_auth_long",
        flag(F.col("failed_auth_short") > 0).alias("recent_auth_failure"),
        (F.col("_e") - F.col("_last")).alias("seconds_since_last_success"),
        flag(F.col("_last").isNotNull()).alias("has_previous_success"),
    )


def with_distinct(rows: DataFrame, key: str, who: str, span: int, counted: Column, name: str) -> DataFrame:
    """Rows (with their epoch _e and _real) and, as rows that are not _real, the changes of how many different `who` a key has seen in a span.

    One of them counts from its latest event until its next one or until the span is over, so the number at any time is
    a running sum of ones that come and go: linear, however busy a key is, where a set in every window is not.
    """
    seen = rows.filter(counted & F.col(who).isNotNull() & F.col(key).isNotNull()).select(F.col(key), "_e", F.col(who).alias("_who")).distinct()
    again = F.lead("_e").over(Window.partitionBy(key, "_who").orderBy("_e"))
    spans = seen.select(key, "_e", F.least(F.coalesce(again, F.col("_e") + span), F.col("_e") + span).alias("_end"))
    points = spans.select(
        key,
        F.explode(F.array(F.struct(F.col("_e"), F.lit(1).alias(name)), F.struct(F.col("_end").alias("_e"), F.lit(-1).alias(name)))).alias("_p"),
    ).select(key, "_p.*")
    return rows.withColumn(name, F.lit(0)).unionByName(points.withColumn("_real", F.lit(False)), allowMissingColumns=True)


def shared_entity(rows: DataFrame, key: str, ts: str, who: str, span: int = HOUR) -> DataFrame:
    """Prior events on an entity (a device) in a span and how many different ones (accounts) they are of.  Rows without a key are one entity's, of nobody."""
    every = with_distinct(rows.withColumn("_e", epoch(ts)).withColumn("_real", F.lit(True)), key, who, span, F.lit(True), "_change")
    real = F.when(F.col("_real"), 1)
    out = every.select(
        "*",
        F.count(real).over(before(key, "_e", span)).alias("prior_events"),
        F.coalesce(F.sum("_change").over(before(key, "_e", None)), F.lit(0)).cast("long").alias("distinct_accounts"),
    )
    return out.filter("_real").drop("_e", "_real", "_change")


def device_authentications(
    subjects: DataFrame,
    logins: DataFrame,
    key: str,
    ts: str,
    who: str,
    success: str,
    short: int = 600,
    long: int = HOUR,
) -> DataFrame:
    """For each subject: failed logins (short), successful ones (long) and different accounts that logged in (long) on its device before."""
    rows = timeline(subjects, logins.withColumn("_login_of", F.col(who)), key, ts, [success, "_login_of"])  # subjects' own accounts don't count
    rows = rows.withColumn("_e", epoch(ts)).withColumn("_real", F.lit(True))
    every = with_distinct(rows, key, "_login_of", long, ~F.col("_subject"), "_change")
    login = F.coalesce(F.col("_real") & ~F.col("_subject"), F.lit(False))
    failed, good = F.when(login & ~F.col(success), 1), F.when(login & F.col(success), 1)
    near, far, ever = (before(key, "_e", s) for s in (short, long, None))
    out = every.select(
        "*",
        F.count(failed).over(near).alias("device_failed_auth_short"),
        F.count(good).over(far).alias("device_successful_auth_long"),
        F.coalesce(F.sum("_change").over(ever), F.lit(0)).cast("long").alias("device_distinct_accounts"),
    )
    return out.filter("_real AND _subject").select(
        *subjects.columns,
        "device_failed_auth_short",
        "device_successful_auth_long",
        "device_distinct_accounts",
    )


def counterparty_history(rows: DataFrame, party: str, ts: str, name: str) -> DataFrame:
    """Strictly prior uses of a counterparty: rows without one are kept out of the window, so they are no partition of their own."""
    e = rows.withColumn("_e", epoch(ts))
    have = e.filter(F.col(party).isNotNull()).select("*", F.count(F.lit(1)).over(before(party, "_e", None)).alias(f"prior_{name}_count"))
    have = have.withColumn(f"is_new_{name}", flag(F.col(f"prior_{name}_count") == 0))
    none = e.filter(F.col(party).isNull()).select(
        "*",
        F.lit(0).cast("long").alias(f"prior_{name}_count"),
        F.lit(None).cast("int").alias(f"is_new_{name}"),
    )
    return have.unionByName(none).withColumn(f"{name}_applicable", flag(F.col(party).isNotNull())).drop("_e")


def profile_features(rows: DataFrame, profiles: DataFrame, key: str, ts: str, amount: str) -> DataFrame:
    """Account profile as of the event: gated by created_at and updated_at, then age, tier, normal amount and what follows from them.

    profiles: key, created_at, updated_at, risk_tier, normal_amount, home_country; rows: also country.
    """
    p = profiles.select(F.col(key).alias("_key"), "created_at", "updated_at", "risk_tier", "normal_amount", "home_country")
    t, created, updated = epoch(ts), seconds(F.col("created_at")), seconds(F.col("updated_at"))
    known = created <= t
    available = flag(known & (F.col("updated_at").isNull() | (updated <= t)))
    out = rows.join(p, rows[key] == p["_key"], "left").withColumn("account_profile_available", available)
    ok = F.col("account_profile_available") == 1
    normal = ok & (F.col("normal_amount") > 0)
    return out.select(
        *rows.columns,
        F.when(known, F.floor((t - created) / DAY).cast("long")).alias("account_age_days"),
        "account_profile_available",
        F.when(ok, F.col("risk_tier")).alias("customer_risk_tier"),
        F.when(ok, F.col("normal_amount")).alias("normal_transaction_amount_usd"),
        flag(normal).alias("normal_transaction_amount_available"),
        F.when(normal, F.col(amount) / F.col("normal_amount")).alias("amount_to_normal_ratio"),
        F.when(normal, F.col(amount) - F.col("normal_amount")).alias("amount_above_normal_usd"),
        F.when(
            ok & F.col("country").isNotNull() & F.col("home_country").isNotNull(),
            (F.col("country") != F.col("home_country")).cast("int"),
        ).alias("country_mismatch"),
    )


def first_seen_features(rows: DataFrame, seen: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """Age of an entity as of the event.  seen: key, first_seen_at."""
    s = seen.select(F.col(key).alias("_key"), "first_seen_at")
    t, first = epoch(ts), seconds(F.col("first_seen_at"))
    out = rows.join(s, rows[key] == s["_key"], "left")
    hours = F.when(first <= t, (t - first) / HOUR)
    return out.select(
        *rows.columns,
        flag(first <= t).alias(f"{name}_profile_available"),
        hours.alias(f"{name}_age_hours"),
        (hours / 24).alias(f"{name}_age_days"),
        F.when(first <= t, (hours <= 24).cast("int")).alias(f"is_new_{name}_24h"),
    )


def history_for(rows: DataFrame, subjects: DataFrame, keys: dict[str, str], ts: str, start: Column, end: Column) -> DataFrame:
    """Rows in [start, end) of any entity that the subjects have: rows' column to subjects' column.  A semi join a key, united, each row once."""
    near = rows.filter((F.col(ts) >= start) & (F.col(ts) < end))
    wanted = None
    for own, theirs in keys.items():
        ids = subjects.select(F.col(theirs).alias("_id")).filter("_id IS NOT NULL").distinct().withColumn(f"_of_{own}", F.lit(True))
        near = near.join(ids, near[own] == ids["_id"], "left").drop("_id")
        wanted = F.col(f"_of_{own}").isNotNull() if wanted is None else wanted | F.col(f"_of_{own}").isNotNull()
    return near.filter(wanted).select(*rows.columns)


def prior_pairs(rows: DataFrame, key: str, ts: str, span: int, bucket: int | None = None) -> DataFrame:
    """Counts of prior events by a range join, for checking windows.

    Times are cut into buckets of the span's length, and a bucket meets itself and the one before, so the join is an equi join.
    """
    size = bucket or span
    e = rows.select(
        F.monotonically_increasing_id().alias("_row") if "_row" not in rows.columns else "_row",
        "*",
    ).withColumn("_e", epoch(ts)) if "_row" not in rows.columns else rows.withColumn("_e", epoch(ts))
    left = e.withColumn("_bucket", F.explode(F.array(*(F.floor(F.col("_e") / size) - i for i in range(span // size + 2)))))
    right = e.select(F.col(key).alias("_k"), F.col("_e").alias("_h"), F.floor(F.col("_e") / size).alias("_b"))
    hit = (F.col("_h") >= F.col("_e") - span) & (F.col("_h") < F.col("_e"))
    return left.join(
        right,
        (left[key] == right["_k"]) & (left["_bucket"] == right["_b"]) & hit,
        "left",
    ).groupBy(*e.columns).agg(F.count("_h").alias("prior_pairs")).drop("_e")


def evidence(rows: DataFrame, key: str, ts: str, id_: str, subject: Column, span: int, most: int = 20) -> DataFrame:
    """For chosen subjects their newest prior events in a span, at most `most` each: what their features were made from."""
    own = rows.filter(subject).select(F.col(key).alias("_k"), F.col(id_).alias("subject_id"), epoch(ts).alias("_t"))
    own = own.withColumn(  # times in buckets of the span, so the join is an equi join
        "_bucket",
        F.explode(F.array(F.floor(F.col("_t") / span), F.floor(F.col("_t") / span) - 1)),
    )
    e = rows.withColumn("_e", epoch(ts)).withColumn("_of", F.floor(F.col("_e") / span))
    prior = e.join(own, (e[key] == own["_k"]) & (e["_of"] == own["_bucket"]) & (F.col("_e") < F.col("_t")) & (F.col("_e") >= F.col("_t") - span))
    newest = Window.partitionBy("subject_id").orderBy(F.col(ts).desc(), F.col(id_).desc())
    return prior.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= most).select(
        "subject_id",
        *rows.columns,
        (F.col("_t") - F.col("_e")).alias("age_seconds"),
    )


#: Inputs of the models, by family.
MODEL_INPUTS = {
    "current": (
        "asset",
        "transaction_type",
        "country",
        "transaction_amount_usd",
        "crypto_quantity",
        "market_price_usd",
        "transaction_hour_utc",
        "transaction_day_of_week_utc",
        "is_weekend_utc",
        "is_night_transaction_utc",
    ),
    "account": (
        "account_age_days",
        "account_profile_available",
        "customer_risk_tier",
        "normal_transaction_amount_usd",
        "normal_transaction_amount_available",
        "amount_to_normal_ratio",
        "amount_above_normal_usd",
        "transaction_country_mismatch_home_country",
    ),
    "history": (
        "prior_tx_count_5m",
        "prior_tx_count_1h",
        "prior_tx_count_24h",
        "prior_tx_amount_sum_1h",
        "prior_tx_amount_sum_24h",
        "prior_tx_amount_avg_24h",
        "prior_tx_amount_max_24h",
        "has_prior_tx_24h",
        "seconds_since_previous_tx",
        "has_previous_transaction",
    ),
    "authentication": (
        "failed_auth_count_10m",
        "failed_auth_count_1h",
        "successful_auth_count_1h",
        "recent_auth_failure_flag_10m",
        "seconds_since_last_successful_auth",
        "has_previous_successful_auth",
    ),
    "device": (
        "device_failed_auth_count_10m",
        "device_successful_auth_count_1h",
        "device_distinct_account_count_1h",
        "device_profile_available",
        "device_age_hours",
        "device_age_days",
        "is_new_device_24h",
    ),
    "wallet": (
        "source_wallet_applicable",
        "destination_wallet_applicable",
        "destination_wallet_first_seen_available",
        "destination_wallet_age_hours",
        "is_new_destination_wallet",
        "prior_destination_wallet_tx_count",
        "prior_source_wallet_tx_count",
    ),
    "market": (
        "market_data_freshness_seconds",
        "latest_market_close_usd",
        "market_return_5m",
        "market_return_1h",
        "market_volatility_1h",
        "market_volume_sum_1h",
        "market_data_available",
    ),
}


def account_history(transactions: DataFrame, logins: DataFrame) -> DataFrame:
    """Transactions with what their account did before: payments and logins in one timeline, so one exchange and one sort."""
    rows = timeline(transactions, logins, "account_id", "feature_timestamp", ["login_success"]).withColumn("_e", epoch("feature_timestamp"))
    w = {n: before("account_id", "_e", s) for n, s in (("5m", 300), ("10m", 600), ("1h", HOUR), ("24h", DAY), ("ever", None))}
    paid = F.when(F.col("_subject"), 1)
    amount = F.when(F.col("_subject"), F.col("transaction_amount_usd"))
    failed, good = (F.when(~F.col("_subject") & (F.col("login_success") == x), 1) for x in (False, True))
    at = lambda c: F.max(F.when(c.isNotNull(), F.col("_e"))).over(w["ever"])
    out = rows.select(
        "*",
        *(F.count(paid).over(w[n]).alias(f"prior_tx_count_{n}") for n in ("5m", "1h", "24h")),
        *(F.coalesce(F.sum(amount).over(w[n]), F.lit(0.0)).alias(f"prior_tx_amount_sum_{n}") for n in ("1h", "24h")),
        F.avg(amount).over(w["24h"]).alias("prior_tx_amount_avg_24h"),
        F.max(amount).over(w["24h"]).alias("prior_tx_amount_max_24h"),
        at(paid).alias("_paid"),
        *(F.count(failed).over(w[n]).alias(f"failed_auth_count_{n}") for n in ("10m", "1h")),
        F.count(good).over(w["1h"]).alias("successful_auth_count_1h"),
        at(good).alias("_logged"),
    ).filter("_subject")
    extra = {
        "has_prior_tx_24h": flag(F.col("prior_tx_count_24h") > 0),
        "seconds_since_previous_tx": F.col("_e") - F.col("_paid"),
        "has_previous_transaction": flag(F.col("_paid").isNotNull()),
        "recent_auth_failure_flag_10m": flag(F.col("failed_auth_count_10m") > 0),
        "seconds_since_last_successful_auth": F.col("_e") - F.col("_logged"),
        "has_previous_successful_auth": flag(F.col("_logged").isNotNull()),
    }
    return out.withColumns(extra).drop("_e", "_subject", "login_success", "_paid", "_logged")


def wallet_history(rows: DataFrame) -> DataFrame:
    """Strictly prior uses of both wallets.  A transaction without one is a key of its own, so missing wallets are no partition."""
    e = rows.withColumn("_e", epoch("feature_timestamp"))
    for side in ("destination", "source"):
        wallet = F.col(f"{side}_wallet_id").cast("string")
        key = F.coalesce(F.concat(F.lit("w"), wallet), F.concat(F.lit("none"), F.col("transaction_id").cast("string")))
        e = e.withColumn("_w", key)
        uses = F.count(F.lit(1)).over(before("_w", "_e", None))
        e = e.select(
            "*",
            F.when(wallet.isNotNull(), uses).otherwise(0).cast("long").alias(f"prior_{side}_wallet_tx_count"),
            flag(wallet.isNotNull()).alias(f"{side}_wallet_applicable"),
        ).drop("_w")
    new = F.when(F.col("destination_wallet_id").isNotNull(), flag(F.col("prior_destination_wallet_tx_count") == 0))
    return e.withColumn("is_new_destination_wallet", new).drop("_e")


def feature_rows(
    transactions: DataFrame,
    accounts: DataFrame,
    devices: DataFrame,
    wallets: DataFrame,
    logins: DataFrame,
    states: DataFrame,
    products: dict[str, str],
) -> DataFrame:
    """Transactions with all inputs of the models.

    transactions: transaction_id, account_id, device_id, source_wallet_id, destination_wallet_id, feature_timestamp, asset,
    transaction_type, country, transaction_amount_usd, crypto_quantity, market_price_usd; accounts: account_id, created_at,
    updated_at, risk_tier, normal_amount, home_country; devices and wallets: id and first_seen_at; logins: account_id,
    device_id, feature_timestamp, login_success; states: product, candle_end, close, return_short, return_long, volatility,
    volume_sum; products: of an asset.
    """
    from sluice.functions.typing import mapped
    from sluice.operators.market import as_of

    rows = account_history(transactions, logins.select("account_id", "feature_timestamp", "login_success"))
    rows = device_authentications(
        rows,
        logins.select("account_id", "device_id", "feature_timestamp", "login_success"),
        "device_id",
        "feature_timestamp",
        "account_id",
        "login_success",
    )
    rows = wallet_history(rows)
    rows = calendar_features(rows, "feature_timestamp")
    rows = profile_features(rows, accounts, "account_id", "feature_timestamp", "transaction_amount_usd")
    rows = first_seen_features(rows, devices, "device_id", "feature_timestamp", "device")
    rows = first_seen_features(
        rows,
        wallets.withColumnRenamed("wallet_id", "destination_wallet_id"),
        "destination_wallet_id",
        "feature_timestamp",
        "destination_wallet",
    )
    rows = rows.withColumn("market_product_id", mapped(F.col("asset"), products))
    rows = as_of(
        rows,
        states,
        "market_product_id",
        "feature_timestamp",
        "product",
        "candle_end",
        ["close", "return_short", "return_long", "volatility", "volume_sum"],
    )
    names = {
        "hour_utc": "transaction_hour_utc", "day_of_week_utc": "transaction_day_of_week_utc", "is_night_utc": "is_night_transaction_utc", "country_mismatch": "transaction_country_mismatch_home_country",
        "device_failed_auth_short": "device_failed_auth_count_10m", "device_successful_auth_long": "device_successful_auth_count_1h", "device_distinct_accounts": "device_distinct_account_count_1h",
        "destination_wallet_profile_available": "destination_wallet_first_seen_available", "close": "latest_market_close_usd", "return_short": "market_return_5m", "return_long": "market_return_1h",
        "volatility": "market_volatility_1h", "volume_sum": "market_volume_sum_1h", "freshness_seconds": "market_data_freshness_seconds",
    }
    rows = rows.withColumnsRenamed(names)
    inputs = [c for family in MODEL_INPUTS.values() for c in family]
    identity = ("transaction_id", "account_id", "device_id", "source_wallet_id", "destination_wallet_id", "feature_timestamp", "market_product_id")
    return rows.select(*identity, *inputs)
