"""The session that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "sluice", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; conf adds to or replaces these settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.ui.enabled": "false"}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
