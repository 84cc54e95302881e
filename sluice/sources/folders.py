"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's spark.checkpoint.dir; where that is unset, as in tests, in a folder of the context's own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_sluice_folder", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = context._sluice_folder = tempfile.mkdtemp(prefix="shared-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
