"""All named queries of the library, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.plans import feature_queries, gold_queries, quality_queries, report_queries, rule_queries, stream_queries

MODULES = (quality_queries, rule_queries, feature_queries, gold_queries, report_queries, stream_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES: dict[str, str] = {k: v for m in MODULES for k, v in m.ORACLES.items()}
