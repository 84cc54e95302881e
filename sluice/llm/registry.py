"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.forest import op4_forest
from sluice.llm.katz import op3_katz
from sluice.llm.langid import op10_language
from sluice.llm.mainhtml import op8_html
from sluice.llm.media import op1_media
from sluice.llm.minhash import op7_minhash
from sluice.llm.packing import op5_packing
from sluice.llm.pieces import op9_pieces
from sluice.llm.quality import op2_quality
from sluice.llm.secretscan import op6_secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_media,
    op2_quality,
    op3_katz,
    op4_forest,
    op5_packing,
    op6_secrets,
    op7_minhash,
    op8_html,
    op9_pieces,
    op10_language,
)}
ORACLES: dict[str, str] = {}
