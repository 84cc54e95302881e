"""Nulls, empty and very long texts, repeats, clashing columns and empty tables, for every operator and stage."""

import os
import re

import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import forest, katz, langid, mainhtml, media, minhash, packing, pieces, quality, secretscan
from sluice.llm.batches import let_go
from sluice.llm.scratch import settled

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, score double, node long, copy string, _words string, _row string, held string, bands int, root int, rank int, _n int"
LONG = "lorem ipsum dolor sit amet consectetur " * 8000 + "x" * 5000
PROSE = "the quick brown fox jumps over the lazy dog and runs away from here to there "


def documents(spark, empty=False):
    extra = ("x", 0.5, 1, "c", "w", "r", "h", 3, 4, 5, 6)
    rows = [
        (None, "an orphan text", "en", "s", 5),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "   \n\t ", "en", "s", 6),
        (4, LONG, "en", "s", len(LONG)),
        (5, PROSE * 4, "en", "s", 100),
        (6, PROSE * 4, "en", "s", 100),
        (6, PROSE * 4, "en", "s", 100),
        (7, PROSE * 3 + "and one more end", "en", "s", 90),
        (8, "nur ein kleiner Satz über das Wetter", "de", "s", 30),
        (9, "12345 !!! ###", "de", "s", 10),
    ]
    rows += [(20 + i, f"satz nummer {i} ist der {i}te von vielen und die sonne scheint", "de", "s", 50) for i in range(12)]
    rows += [(60 + i, f"sentence number {i} is one of many and the sun shines here", "en", "s", 50) for i in range(12)]
    frame = spark.createDataFrame([r + extra for r in rows], SCHEMA)
    return frame.limit(0) if empty else frame


def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, 0) for i in range(100)] + [(None, 1, 0), (5, None, None), (21, 0, 0)],
        "doc_id long, quality int, toxic int",
    )


OPERATORS = {
    "media": lambda s, d: media.media_columns(d),
    "quality": lambda s, d: quality.classified(d, labels(s)),
    "katz": lambda s, d: katz.scored(d.drop("held").withColumn("held", F.col("doc_id") % 10 == 0).withColumn(
        "held",
        F.coalesce("held", F.lit(True)),
    )),
    "pieces": lambda s, d: pieces.piece_digests(d, PIECE),
    "minhash": lambda s, d: minhash.grouped(d),
    "language": lambda s, d: langid.identified(d, PIECE),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_per_document_whatever_it_holds(spark, name):
    out = OPERATORS[name](spark, documents(spark)).collect()
    assert len(out) == documents(spark).count()
    assert sum(r["doc_id"] is None for r in out) == 1
    six = [tuple(str(v) for v in r) for r in out if r["doc_id"] == 6]
    assert six[0] == six[1]


@pytest.mark.parametrize("name", [*OPERATORS, "packing", "secrets"])
def test_empty_tables_give_no_rows(spark, name):
    run = OPERATORS.get(name) or {"packing": lambda s, d: packing.packed(d, WORD), "secrets": lambda s, d: secretscan.findings(d)}[name]
    assert run(spark, documents(spark, empty=True)).count() == 0


def test_empty_pages_and_vectors(spark):
    pages = spark.createDataFrame(
        [
            (None, None, None, 1),
            (1, "u", "", 1),
            (2, "u", "plain words", 1),
            (3, "u", "<p>" * 3000 + "deep", 1),
            (4, "u", "<div class='a", 1),
            (4, "u", "<article><p>x &amp; y&nbsp;z</p></article>", 1),
        ],
        "page_id long, url string, html string, text int",
    )
    out = mainhtml.extracted(pages).collect()
    assert len(out) == 6 and all(r.n_chars == len(r.text) for r in out)
    assert sorted(r.text for r in out if r.page_id == 4)[-1] == "x & y z"
    assert mainhtml.extracted(pages.limit(0)).count() == 0
    vectors = spark.createDataFrame(
        [
            (1, None),
            (2, []),
            (3, [0.0, 0.0]),
            (4, [1.0, None]),
            (5, [float("nan"), 1.0]),
            (20, [1.0, 0.0]),
            (21, [1.0, 0.0]),
            (22, [0.5, 0.5]),
            (None, [1.0, 1.0]),
            (40, [1.0, 2.0, 3.0]),
        ],
        "vec_id long, embedding array<double>",
    )
    out = [tuple(r) for r in forest.nearest(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert out == [(20, 1, 21, 1.0), (20, 2, 22, 0.5)]
    assert forest.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    docs, path = documents(spark), str(tmp_path)
    labels(spark).write.parquet(f"{path}/labels.parquet")
    docs.write.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), path).count() == 0, name
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, path).collect()}
    assert 5 in kept and 6 not in kept and None in kept
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in corpus_pipeline.language_id(spark, docs, path).collect()}
    assert gone == {1, 2, 3, 9}
    out = corpus_pipeline.run(spark, path).collect()
    assert out and {"doc_id", "sequence_id", "offset"} <= set(out[0].asDict())


def test_redaction_with_clashing_columns(spark):
    docs = documents(spark).withColumn(
        "text",
        F.when(F.col("doc_id") == 8, "see password=b7db7aa4a5fcc783 now").otherwise(F.col("text")),
    ).withColumn("_secrets", F.lit("mine"))
    out = {r.doc_id: r for r in secretscan.redacted(docs).collect()}
    assert out[8].text == "see password=[SECRET] now" and out[8].n_chars == len(out[8].text) and out[8]._secrets == "mine"
    assert out[4].text == LONG


def test_the_driver_gives_freed_native_memory_back(spark):
    """Compressors' memory is malloc's; one that stays open keeps what others freed from going back by itself."""
    jvm = spark._jvm
    status = f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup"
    if not os.path.exists(status) or tuple(map(int, jvm.java.lang.System.getProperty("java.version").split(".")[:3])) < (17, 0, 9):
        pytest.skip("no Linux, or a Java that can't")

    def used():
        with open(status) as f:
            return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024

    made = [jvm.java.util.zip.Deflater() for _ in range(1000)]
    for x in made[:-1]:
        x.end()
    let_go()
    for _ in range(4):  # what goes by a collection alone, goes before
        jvm.System.gc()
    before = used()
    settled(spark)
    after = used()
    made[-1].end()
    assert after < before - 60
