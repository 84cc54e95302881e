"""Bounded samples of labelled rows, the same for the same rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sampled(labelled: DataFrame, label: str, bound: int, least: int = 50) -> DataFrame:
    """About `bound` of the rows doc_id, label: evenly from each label, by a hash of the id.

    Only ids and labels are looked at.  The labels themselves are few (a
    language, a flag); with more than bound / least of them each still gets
    `least` rows.  Rows without an id or a label are left out, and an id that
    comes several times is a single row with its smallest label.
    """
    rows = labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias(label))
    counts = rows.groupBy(label).count().collect()
    if not counts:
        return rows.select("doc_id", label).limit(0)
    share = max(least, bound // len(counts))
    rest, cut = bound, {}
    for k, (value, n) in enumerate(sorted(counts, key=lambda r: r[1])):  # what small labels leave goes to the larger
        own = max(share, rest // (len(counts) - k))
        cut[value] = min(1.0, own / n)
        rest -= min(n, own)
    kept = rows.sparkSession.createDataFrame(list(cut.items()), f"{label} {rows.schema[label].dataType.simpleString()}, _cut double")
    place = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(kept), label).filter(place < F.col("_cut")).select("doc_id", label)
