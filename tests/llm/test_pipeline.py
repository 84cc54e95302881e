"""Each stage of the pipeline against a plain version of it, on what the stage before kept."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import groups_by_hand

import corpus_pipeline
from sluice.llm import langid, quality, secretscan
from sluice.llm.batches import remainder

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    """name: (rows before, rows after), as lists of rows."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS).cache()
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, DATA).cache()
        out[name] = (docs.collect(), after.collect())
        if name != "best_fit_packing":
            assert after.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(out[name][1], after.schema)
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality_keeps_what_it_predicts_to_be_good(spark, stages):
    before, after = stages["quality_classifier"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").filter(remainder(F.col("doc_id"), 3) != 1).select("doc_id", F.col("quality").alias("label"))
    machine = quality.fitted(docs, labels)
    good = {r.doc_id for r in quality.scored(docs, machine).collect() if r.score >= 0.5}
    assert ids(after) == sorted(i for i in ids(before) if i in good) and 0 < len(after) < len(before)


def test_language_keeps_texts_with_a_language(spark, stages):
    before, after = stages["language_id"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    learn = docs.filter(remainder(F.col("doc_id"), 5) != 0).select("doc_id", "lang")
    model = langid.fitted(docs, learn, public_tokenizers.path("piece_bpe_32k.model"))
    kept = []
    for r in before:  # a document at a time, word by word
        runs = langid.runs(r.text or "")
        if not runs:
            continue
        scores = model.word_scores(runs)
        total = scores.sum(0)
        best = total.argmax()
        share = 1 / np.exp(total - total[best]).sum()
        usual = scores[:, best] / [len(x) for x in runs] >= model.usual[best, 0] - langid.FAR * model.usual[best, 1]
        if share >= corpus_pipeline.LEAST_LANGUAGE and (len(runs) < langid.JUDGED or usual.sum() >= len(runs) / 2):
            kept.append(r.doc_id)
    assert ids(after) == sorted(kept)


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before, after = stages["near_dedup"]
    rows = sorted(before, key=lambda r: r.doc_id)
    groups = groups_by_hand([r.text or "" for r in rows])
    assert ids(after) == sorted(rows[g].doc_id for g in set(groups))
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def test_secret_scan_replaces_findings_only(spark, stages):
    before, after = stages["secret_scan"]
    assert ids(after) == ids(before)
    key = lambda r: hashlib.sha256(str(r.doc_id % 5).encode()).hexdigest()[:40]
    before = [r if r.doc_id % 3 else type(r)(**r.asDict() | {"text": f'{r.text} token = "{key(r)}" end', "n_chars": 0}) for r in before]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    after = corpus_pipeline.secret_scan(spark, docs, DATA).collect()
    found: dict = {}
    for r in secretscan.findings(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    new = {r.doc_id: r for r in after}
    assert sorted(new) == ids(before) and {r.doc_id for r in before if r.doc_id % 3 == 0} <= set(found)
    for r in before:
        text = r.text
        for f in sorted(found.get(r.doc_id, []), key=lambda f: -f.length):
            secret = r.text[f.start : f.start + f.length]
            assert hashlib.sha256(secret.encode()).hexdigest() == f.secret_sha256 and r.text.count(secret) >= f.occurrences
            text = text.replace(secret, "[SECRET]")
        assert new[r.doc_id].text == text and new[r.doc_id].n_chars == (len(text) if r.doc_id in found else r.n_chars)


def test_packing_places_every_piece(stages):
    from tokenizers import Tokenizer

    before, after = stages["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in before:
        own = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want |= {(r.doc_id, k): own[s : s + 4096] for k, s in enumerate(range(0, len(own), 4096))}
    assert {(r.doc_id, r.piece) for r in after} == set(want) and len(after) == len(want)
    places: dict = {}
    for r in after:
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id, r.piece], "<u4").tobytes())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(places) <= -(-sum(map(len, want.values())) // 4096) + 1
