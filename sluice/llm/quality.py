"""Quality classifier: a factorisation machine over words, structure and metadata.

A document's active features are its distinct words, hashed to BUCKETS numbers
and weighted by 1 + log of how often they come (scaled to length one), one
feature for the bin that each structure statistic falls into, and one for the
bin of its stated length.  The score is

    sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

where the last sum, over FACTORS, gives all pairwise interactions in time
linear in the active features.  Labels are learnt by AdaGrad on the driver
from at most about SAMPLE_DOCS labelled documents; whatever the corpus, the
model has (BUCKETS + statistics x bins) x (FACTORS + 1) numbers.

Nulls, empty and long texts: a null text counts as empty; an empty text has a
score from its statistics; long texts are read whole.  A null n_chars has a
bin of its own; a null id or label is not learnt from; contrary labels of one
id count as the smaller.  Without any labels every score is 0.5.  With labels of
one kind only every score is 0.5, too.  Repeated rows give repeated results; an
empty table gives no rows.  Other columns are
never looked at.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import arrow_map, gathered, held, let_go, remainder, table, text_slices, words
from sluice.llm.samples import sampled
from sluice.llm.scratch import settled

SAMPLE_DOCS, BUCKETS, FACTORS, BINS, ROUNDS = 8000, 1 << 17, 8, 16, 6
#: Byte classes that structure is told by.
CLASSES = ("upper", "lower", "digit", "space", "line", "stop", "bar", "bang", "sign", "quote", "other", "wide")
STATS = (*CLASSES, "words", "distinct", "word_bytes", "line_words", "bytes", "stated")
_CLASS = np.full(256, CLASSES.index("other"), np.uint8)
for _name, _bytes in (
    ("upper", range(65, 91)),
    ("lower", range(97, 123)),
    ("digit", range(48, 58)),
    ("space", b" \t\x0b\x0c\r"),
    ("line", b"\n"),
    ("stop", b".,;:?"),
    ("bar", b"|"),
    ("bang", b"!"),
    ("sign", b"#$%&*@=+<>~^_/\\"),
    ("quote", b"\"'`()[]{}-"),
    ("wide", range(128, 256)),
):
    _CLASS[list(_bytes)] = CLASSES.index(_name)


class Features:
    """Distinct words with weights and statistics of texts; hashes of words are kept, up to a bound."""

    def __init__(self, limit: int = 400_000):
        self.limit, self.number = limit, {}

    def _hashes(self, distinct: list[str]) -> np.ndarray:
        if len(self.number) + len(distinct) > self.limit:
            self.number.clear()
        number = self.number
        for w in distinct:
            if w not in number:
                number[w] = zlib.crc32(w.encode()) % BUCKETS
        return np.fromiter(map(number.__getitem__, distinct), np.int64, len(distinct))

    def __call__(self, text: pa.Array, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of words of each text, their features, their weights, statistics)."""
        start, code, distinct = words(text)
        n, hashes = len(text), self._hashes(distinct)
        doc = np.repeat(np.arange(n), np.diff(start))
        pair, times = np.unique(doc * BUCKETS + hashes[code], return_counts=True)
        of, feature = pair // BUCKETS, pair % BUCKETS
        weight = 1 + np.log(times)
        weight /= np.sqrt(np.bincount(of, weight**2, n))[of]
        lens = np.bincount(of, minlength=n)
        plain = text.cast(pa.large_binary())
        offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + n + 1]
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        size = np.diff(offsets)
        k = len(CLASSES)
        classes = np.bincount(np.repeat(np.arange(n) * k, size) + _CLASS[data], minlength=n * k).reshape(n, k)
        count, total = np.diff(start), np.maximum(size, 1)
        stats = np.column_stack([
            classes / total[:, None],
            np.log1p(count),
            lens / np.maximum(count, 1),
            size / np.maximum(count, 1),
            count / (classes[:, CLASSES.index("line")] + 1),
            np.log1p(size),
            np.log1p(np.where(np.isnan(stated), 0, stated)),
        ])
        stats[np.isnan(stated), -1] = np.nan
        return lens, feature, weight, stats


@dataclass
class Machine:
    """A factorisation machine whose statistics fall into bins at `edges`."""

    edges: np.ndarray  # statistic x (BINS - 1)
    w0: float
    w: np.ndarray
    v: np.ndarray

    @classmethod
    def empty(cls, edges: np.ndarray, seed: int = 5) -> Machine:
        n = BUCKETS + len(edges) * (BINS + 1)
        return cls(edges, 0.0, np.zeros(n), np.random.default_rng(seed).normal(0, 0.02, (n, FACTORS)))

    def active(self, lens: np.ndarray, feature: np.ndarray, weight: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of each document's features and the end, features, values), statistics' bins last."""
        n, m = stats.shape
        bins = np.column_stack([np.where(np.isnan(s), BINS, np.searchsorted(e, s, "right")) for e, s in zip(self.edges, stats.T)])
        extra = BUCKETS + np.arange(m) * (BINS + 1) + bins
        start = np.concatenate([[0], np.cumsum(lens + m)])
        at, value = np.zeros(start[-1], np.int32), np.full(start[-1], 1 / np.sqrt(m), np.float32)
        mine = np.ones(start[-1], bool)
        mine[(start[1:, None] - m + np.arange(m)).ravel()] = False
        at[mine], value[mine] = feature, weight
        at[~mine] = extra.ravel()
        return start, at, value

    def margins(self, start: np.ndarray, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(w0 + linear and pairwise parts, sum of v x by document)."""
        vx = self.v[at] * value[:, None]
        total = np.add.reduceat(vx, start[:-1], axis=0)
        square = np.add.reduceat((vx * vx).sum(1), start[:-1])
        return self.w0 + np.add.reduceat(self.w[at] * value, start[:-1]) + 0.5 * ((total * total).sum(1) - square), total

    def fit(
        self,
        start: np.ndarray,
        at: np.ndarray,
        value: np.ndarray,
        y: np.ndarray,
        rounds: int = ROUNDS,
        rate: float = 0.08,
        decay: float = 1e-5,
        seed: int = 7,
    ) -> Machine:
        rng, g0, gw, gv = np.random.default_rng(seed), 1e-8, np.full(len(self.w), 1e-8), np.full(self.v.shape, 1e-8)
        self.w0 = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        for _ in range(rounds):
            order = rng.permutation(len(y))
            for a in range(0, len(order), 32):
                docs = order[a : a + 32]
                lens = start[docs + 1] - start[docs]
                own = np.concatenate([np.arange(start[d], start[d + 1]) for d in docs])
                f, x = at[own], value[own]
                margin, total = self.margins(np.concatenate([[0], np.cumsum(lens)]), f, x)
                slope = (1 / (1 + np.exp(-margin)) - y[docs]) / len(docs)
                each = np.repeat(slope, lens) * x
                single, of = np.unique(f, return_inverse=True)
                dw = np.bincount(of, each, len(single)) + decay * self.w[single]
                inner = each[:, None] * (np.repeat(total, lens, axis=0) - self.v[f] * x[:, None])
                dv = np.column_stack([np.bincount(of, c, len(single)) for c in inner.T]) + decay * self.v[single]
                g0 += slope.sum() ** 2
                gw[single] += dw * dw
                gv[single] += dv * dv
                self.w0 -= rate * slope.sum() / np.sqrt(g0)
                self.w[single] -= rate * dw / np.sqrt(gw[single])
                self.v[single] -= rate * dv / np.sqrt(gv[single])
        return self

    def scores(self, *features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(*self.active(*features))[0]))


def _stated(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column(rows.schema.get_field_index("n_chars")).cast(pa.float64()).to_numpy(zero_copy_only=False)


def _featured(batches):
    make = Features()
    for batch in batches:
        for rows, text in text_slices(batch):
            lens, feature, weight, stats = make(text, _stated(rows))
            cut = np.concatenate([[0], np.cumsum(lens)])
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(rows.schema.get_field_index("label")).cast(pa.int32()),
                    lists(feature, pa.int32()),
                    lists(weight, pa.float32()),
                    pa.array(list(stats), pa.list_(pa.float64())),
                ],
                names=["label", "feature", "weight", "stats"],
            )


def fitted(docs: DataFrame, labelled: DataFrame, bound: int = SAMPLE_DOCS) -> Machine | None:
    """The machine of labelled documents (doc_id, label); None if the labels are all alike."""
    sample = sampled(labelled, "label", bound)
    own = docs.select("doc_id", "text", "n_chars").join(F.broadcast(sample), "doc_id").select("text", "n_chars", "label")
    rows = arrow_map(own, _featured, "label int, feature array<int>, weight array<float>, stats array<double>").toArrow()
    y = rows.column("label").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return None
    feature, weight = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column(k).chunks]) for k in ("feature", "weight"))
    lens = pc.list_value_length(rows.column("feature")).to_numpy().astype(np.int64)
    stats = np.array(rows.column("stats").to_pylist(), float)
    order = np.lexsort((  # whatever order the rows came in
        feature[np.minimum(np.cumsum(lens) - lens, max(0, len(feature) - 1))] if len(feature) else lens,
        stats[:, -2],
        y,
    ))
    if len(feature):
        first = np.cumsum(lens) - lens
        feature, weight = (gathered(first[order], lens[order], x) for x in (feature, weight))
    lens, stats, y = lens[order], stats[order], y[order]
    edges = np.nan_to_num(np.nanquantile(np.where(np.isnan(stats).all(0), 0, stats), np.arange(1, BINS) / BINS, axis=0).T)
    machine = Machine.empty(edges)
    active = machine.active(lens, feature, weight, stats)
    del rows, feature, weight
    settled(docs.sparkSession)
    machine = machine.fit(*active, y)
    del active
    let_go()
    return machine


def _scoring(spark: SparkSession, machine: Machine):
    """A function that runs on executors: scores of the rows of a batch, slice by slice."""
    shared, name = spark.sparkContext.broadcast((
        machine.edges,
        machine.w0,
        machine.w.astype(np.float32),
        machine.v.astype(np.float32),
    )), uuid.uuid4().hex

    def scores(batch):
        own, make = held(("quality", name), lambda: (Machine(*shared.value), Features()))
        for part, text in text_slices(batch, 2 << 20):
            yield part, own.scores(*make(text, _stated(part))).astype(float)

    return scores


def scored(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id, score and predicted of each document."""
    if machine is None:
        return docs.select("doc_id", F.lit(0.5).cast("double").alias("score"), F.lit(1).alias("predicted"))
    scores = _scoring(docs.sparkSession, machine)

    def rows(batches):
        for batch in batches:
            for part, score in scores(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return arrow_map(docs.select("doc_id", "text", "n_chars"), rows, "doc_id long, score double, predicted int")


def selected(docs: DataFrame, machine: Machine | None, least: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is `least` or more."""
    if machine is None:
        return docs
    scores = _scoring(docs.sparkSession, machine)

    def rows(batches):
        for batch in batches:
            for part, score in scores(batch):
                yield part.filter(pa.array(score >= least))

    return arrow_map(docs, rows, docs.schema)


def classified(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS, folds: int = 3) -> DataFrame:
    """Fits on labels outside the held-out fold and scores all documents.  labels: doc_id, quality."""
    out = lambda x: F.coalesce(remainder(x, folds) == 1, F.lit(True))
    machine = fitted(docs, labels.filter(~out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("label")), bound)
    return scored(docs, machine).select("doc_id", out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document, learnt from labels outside the held-out fold."""
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
