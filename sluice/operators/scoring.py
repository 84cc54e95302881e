"""Decisions, reason codes and alert payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.predicates import is_alert
from sluice.functions.typing import uuid5

THRESHOLD = 0.80
#: Fixed reason codes: code, feature, least value.
REASON_CODES = (
    ("NEW_DEVICE", "is_new_device_24h", 1),
    ("NEW_COUNTRY", "country_mismatch", 1),
    ("HIGH_TRANSACTION_VELOCITY", "prior_count_1h", 3),
    ("UNUSUAL_AMOUNT", "amount_to_normal_ratio", 4.0),
    ("NEW_DESTINATION_WALLET", "is_new_destination_wallet", 1),
    ("FAILED_LOGIN_ACTIVITY", "recent_auth_failure", 1),
    ("HIGH_MARKET_VOLATILITY", "volatility", 0.02),
    ("SUSPICIOUS_SHARED_DEVICE", "distinct_accounts", 3),
)


def reason_codes(predicted: Column, columns: list[str]) -> Column:
    """The codes whose feature reaches its least value, in fixed order; none unless fraud is predicted."""
    own = [F.when(F.col(c) >= least, F.lit(code)) for code, c, least in REASON_CODES if c in columns]
    none = F.array().cast("array<string>")
    return F.when(predicted, F.array_compact(F.array(*own)) if own else none).otherwise(none)


def decided(
    rows: DataFrame,
    probability: str,
    event: str,
    clock: Column,
    threshold: float = THRESHOLD,
    model: str = "model",
    version: str = "1",
) -> DataFrame:
    """Adds the flag, REVIEW or ALLOW, reason codes, model and latency (never below 0 ms)."""
    p = F.col(probability)
    predicted = p >= threshold
    latency = F.greatest((F.unix_micros(clock.cast("timestamp")) - F.unix_micros(F.col(event).cast("timestamp"))) / 1000.0, F.lit(0.0))
    return rows.select(
        "*",
        predicted.alias("predicted"),
        F.when(predicted, "REVIEW").otherwise("ALLOW").alias("decision"),
        reason_codes(predicted, rows.columns).alias("reason_codes"),
        F.lit(model).alias("model_name"),
        F.lit(version).alias("model_version"),
        latency.alias("processing_latency_ms"),
    )


def decision_events(
    rows: DataFrame,
    probability: str,
    event: str,
    clock: Column,
    features: list[str],
    expected: list[str],
    threshold: float = THRESHOLD,
    model: str = "model",
    version: str = "1",
    policy: str = "1.0",
) -> DataFrame:
    """The decision message of each scored transaction, 24 fields.

    rows: transaction_id, asset, country, transaction_amount_usd, the probability and the features; features: those the
    model was given, in order, and expected: those of its contract.  The id follows from transaction and model, so a
    replay gives the same message.
    """
    done = decided(rows, probability, event, clock, threshold, model, version)
    now = F.date_format(clock.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    p = F.col(probability)
    fields = {
        "event_id": uuid5(F.concat_ws(":", F.lit("decision"), F.col("transaction_id").cast("string"), F.lit(model), F.lit(version))),
        "event_type": F.lit("fraud_decision"),
        "schema_version": F.lit("1.0"),
        "source": F.lit("realtime_scoring_pipeline"),
        **dict.fromkeys(("event_timestamp", "source_timestamp", "ingestion_timestamp"), now),
        **{c: F.col(c) for c in ("transaction_id", "asset", "country", "transaction_amount_usd")},
        "risk_score": p,
        **{c: F.col(c) for c in ("decision", "reason_codes", "model_name", "model_version")},
        "prediction_timestamp": now,
        "processing_latency_ms": F.col("processing_latency_ms"),
        "threshold_policy_version": F.lit(policy),
        "fraud_probability": p,
        "predicted_fraud": F.col("predicted"),
        "fraud_threshold": F.lit(threshold),
        "feature_count": F.lit(len(features)),
        "input_contract_ok": F.lit(features == expected),
    }
    return done.select(*(c.alias(n) for n, c in fields.items()))


def alerts(events: DataFrame, threshold: float = THRESHOLD, title: str = "High-risk transaction") -> DataFrame:
    """Payload and message of each event that is an alert.

    events: event_type, predicted, fraud_probability, risk_score, transaction_id, event_id, decision.
    """
    p = F.coalesce("fraud_probability", "risk_score")
    hit = events.filter(is_alert(F.col("event_type"), F.col("predicted"), F.col("fraud_probability"), F.col("risk_score"), threshold))
    out = hit.select(
        F.lit(title).alias("title"),
        F.coalesce("transaction_id", "event_id").alias("transaction_id"),
        p.alias("probability"),
        F.lit(threshold).alias("threshold"),
        F.coalesce("decision", F.lit("REVIEW")).alias("decision"),
    )
    return out.withColumn(
        "message",
        F.format_string(
            "%s: transaction %s scored %.4f (threshold %.2f), decision %s",
            "title",
            F.col("transaction_id").cast("string"),
            "probability",
            "threshold",
            "decision",
        ),
    )


def test_alert(rows: DataFrame) -> DataFrame:
    """One alert that is plainly a test."""
    return rows.sparkSession.range(1).select(
        F.lit("TEST ALERT").alias("title"),
        F.lit("test-transaction").alias("transaction_id"),
        F.lit(1.0).alias("probability"),
        F.lit(True).alias("is_test"),
    )


def payload_counts(payloads: DataFrame, column: str, threshold: float = THRESHOLD, since: tuple[str, Column] | None = None) -> DataFrame:
    """Of JSON decisions (since a time: its column and the start): all, flagged, and flagged at or above the threshold."""
    if since:
        payloads = payloads.filter(F.col(since[0]) >= since[1])
    d = payloads.select(F.from_json(column, "struct<predicted_fraud:boolean,fraud_probability:double,risk_score:double>").alias("d"))
    p = F.coalesce("d.fraud_probability", "d.risk_score")
    return d.agg(
        F.count("*").alias("decisions"),
        F.count(F.when(F.col("d.predicted_fraud"), 1)).alias("flagged"),
        F.count(F.when(F.col("d.predicted_fraud") & (p >= threshold), 1)).alias("high"),
    )
