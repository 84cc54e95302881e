"""The corpus pipeline: five operators in a row, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  `run` writes each stage's result in the
session's shared folder and reads it again for the next.

Nulls, empty and long texts, repeated rows and empty tables are treated as the
operators' docstrings say; a document that no decision is about (a null id)
stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, minhash, packing, quality, secretscan
from sluice.llm.batches import remainder, table
from sluice.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least score of a language for a document to stay.
LEAST_LANGUAGE = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine takes for good ones."""
    held = lambda x: F.coalesce(remainder(x, 3) == 1, F.lit(True))
    labels = table(spark, sf_dir, "labels").filter(~held(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("label"))
    return quality.selected(docs, quality.fitted(docs, labels))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages."""
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    model = langid.fitted(docs, docs.filter(~held).select("doc_id", "lang"), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.selected(docs, model, LEAST_LANGUAGE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id."""
    return minhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of their texts."""
    return secretscan.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents.  What a stage keeps is a table until all are done; the result's stays."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = scratch.kept(stage(spark, docs, sf_dir), name)
    name, last = STAGES[-1]
    return scratch.last(last(spark, docs, sf_dir), name)


#: Learnt models, tokenizers and components are beyond SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None
