"""Katz back-off language model with Good-Turing discounts.

Probabilities, for a word w behind the n - 1 words of a history h, of which h'
lacks the first (a begin mark is the first word of every text):

    P(w | h) = d_c c(h w) / c(h)       if h w was learnt
             = alpha(h) P(w | h')      if only h was learnt
             = P(w | h')               otherwise
    P(w)     = d_c c(w) / N, the rest of the mass for all words not learnt

d_c are Katz's Good-Turing discounts of each order for counts up to K (lowered
where counts of counts do not allow it) and 1 above; alpha(h) makes P(. | h)
sum to one exactly.  A history that came more than K times might have no count
to discount, so RESERVE is added to its count, which keeps a sliver of mass.
The order of the model is a parameter; every token is evaluated from it down,
order by order, until a probability is found.

How it is laid out.  Nothing is broadcast: the model has no size bound.  Texts
are cut into blocks of a bounded number of tokens.  A block numbers its own
words and runs of 2 to `order` words, and for every distinct one it has, sends
the key and its own count to the part of the model that the key's hash belongs
to; parts are ranges of hashes, so no word or run, however common, is more
than one entry a block.  A part sums the counts, is stored as sorted arrays
(one table, a row a part and order), and answers each block in the order it
asked.  Two rounds make a score: counts, then back-off weights.  Keys are
64-bit hashes, so of m distinct runs about m^2 / 2^65 share a count.

Nulls, empty and long texts: a null text counts as empty and has the end token
alone; long texts are read whole.  A null id is scored and not learnt from.
Repeated rows count as often as they come; an empty table gives no rows.
Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import arrow_groups, arrow_map, remainder, table, text_slices, words
from sluice.llm.batches import held as kept_things
from sluice.llm.scratch import dropped, in_files, new_path, settled

ORDER, K, RESERVE, BLOCK_TOKENS = 2, 5, 0.01, 1_500_000
BEGIN, END = 0, 1
#: Counts are summed for so many sets of parts one after another, so that only one set's messages are in shuffle files at a time.
TURNS = 5
#: Hashes of the marks; no word is the empty string, and none holds a space.
_MARKS = [xxhash.xxh3_64_intdigest(" begin"), xxhash.xxh3_64_intdigest(" end")]
MESSAGE = "kind string, block long, part int, body binary"
_MESSAGE = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("body", pa.binary())])
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: each by byte planes, compressed together."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes()
    kinds = "".join(a.dtype.str.ljust(4) for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(
        len(a),
        a.itemsize,
    ).T.tobytes() for a in arrays))


def _unpack(body: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    lens = np.frombuffer(data, "<i8", n, 8).tolist()
    at, out = 8 + 8 * n + 4 * n, []
    for k, size in enumerate(lens):
        kind = np.dtype(data[8 + 8 * n + 4 * k : 12 + 8 * n + 4 * k].decode().strip())
        out.append(np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size).T.copy().view(kind).reshape(size))
        at += size * kind.itemsize
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def _mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hashes of pairs."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + w
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among sorted keys."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1))


class _Block:
    """The tokens of some documents, with begin marks between them."""

    def __init__(self):
        self.names, self.tokens, self.lens, self.ids, self.held, self.n = {}, [], [], [], [], 0

    def add(self, ids: list, held: np.ndarray, start: np.ndarray, code: np.ndarray, distinct: list[str]) -> None:
        names = self.names
        own = np.fromiter((names.setdefault(w, len(names) + 2) for w in distinct), np.int32, len(distinct))
        lens = np.diff(start)
        flat = np.full(len(code) + 2 * len(lens), BEGIN, np.int32)
        first = start[:-1] + 2 * np.arange(len(lens))
        flat[first + lens + 1] = END
        inner = np.ones(len(flat), bool)
        inner[first] = inner[first + lens + 1] = False
        flat[inner] = own[code]
        self.tokens.append(flat)
        self.lens.append(lens + 1)
        self.ids += ids
        self.held.append(held)
        self.n += len(flat)

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the words and marks, in order; tokens as numbers in that order)."""
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(self.names))
        h = np.concatenate([np.array(_MARKS, np.uint64), h])
        order = np.argsort(h)
        rank = np.empty(len(h), np.int32)
        rank[order] = np.arange(len(h), dtype=np.int32)
        return h[order], rank[np.concatenate(self.tokens)]


def _begin(hashes: np.ndarray) -> int:
    """The number of the begin mark."""
    return int(np.searchsorted(hashes, np.uint64(_MARKS[BEGIN])))


class Runs:
    """The distinct runs of n words of a block, n from 1: 1 is the words and marks themselves.

    A run ends at a scored token and does not go over the begin mark.
    """

    def __init__(self, hashes: np.ndarray, of: np.ndarray, history: np.ndarray | None = None, lower: np.ndarray | None = None):
        self.of = of  # number of the run that ends at each token, -1 where there is none
        self.history, self.lower = history, lower  # of each run: numbers of the runs of n - 1 words that begin and end it
        self.order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.keys = hashes[self.order]
        self.rank = np.empty(len(hashes), np.int32)  # the place of each run among sorted keys
        self.rank[self.order] = np.arange(len(hashes), dtype=np.int32)

    @property
    def hashes(self) -> np.ndarray:
        return self.keys[self.rank]

    def longer(self, tokens: np.ndarray, words: Runs) -> Runs:
        """Runs with one word more."""
        at = np.flatnonzero((self.of[:-1] >= 0) & (tokens[1:] != _begin(words.keys))) + 1
        distinct, first, number = np.unique(self.of[at - 1].astype(np.int64) * len(words.keys) + tokens[at], return_index=True, return_inverse=True)
        of = np.full(len(tokens), -1, np.int32)
        of[at] = number
        history, word = (distinct // len(words.keys)).astype(np.int32), (distinct % len(words.keys)).astype(np.int32)
        return Runs(_mixed(self.hashes[history], words.keys[word]), of, history, self.of[at[first]])


def _runs(tokens: np.ndarray, hashes: np.ndarray, order: int) -> list[Runs]:
    """By n - 1; hashes: of words, sorted, and tokens their numbers."""
    out = [Runs(hashes, tokens)]
    while len(out) < order:
        out.append(out[-1].longer(tokens, out[0]))
    return out


def _asking(parts: int, most_tokens: int, order: int):
    def messages(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kept_things(("blocks",), dict)  # lets go of what another operator has kept in this worker
        task, count, block = TaskContext.get().partitionId(), 0, _Block()

        def flush():
            nonlocal count, block
            number = (task << 24) + count
            hashes, tokens = block.numbered()
            lens, held = np.concatenate(block.lens), np.concatenate(block.held)
            learnt = np.repeat(~held, lens + 1)
            ids = np.array([0 if x is None else x for x in block.ids], np.int64)
            rows = [(
                "text",
                number,
                0,
                _pack(ids, np.array([x is None for x in block.ids], np.uint8), held.view(np.uint8), _small(lens), _small(tokens)),
            )]
            for n, runs in enumerate(_runs(tokens, hashes, order), 1):
                own = np.bincount(runs.of[learnt & (runs.of >= 0)], minlength=len(runs.keys))[runs.order]
                cut = _cuts(runs.keys, parts)
                rows += [(
                    str(n),
                    number,
                    p,
                    _pack(np.diff(runs.keys[a:b], prepend=np.uint64(0)), _small(own[a:b])),
                ) for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            count, block = count + 1, _Block()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MESSAGE)], schema=_MESSAGE)

        for batch in batches:
            for rows, text in text_slices(batch):
                held = rows.column(rows.schema.get_field_index("held")).to_numpy(zero_copy_only=False).astype(bool)
                block.add(rows.column(rows.schema.get_field_index("doc_id")).to_pylist(), held, *words(text))
                if block.n >= most_tokens:
                    yield flush()
        if block.n:
            yield flush()

    return messages


def _sums(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys, their sums, where each block's keys are)."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, np.concatenate(values), len(distinct))
    return distinct, total, np.split(at, np.cumsum([len(k) for k in keys])[:-1])


_COUNTED = pa.schema([*_MESSAGE, ("keys", pa.list_(pa.uint64())), ("counts", pa.list_(pa.int64())), ("stats", pa.list_(pa.int64()))])
COUNTED = MESSAGE + ", keys array<long>, counts array<long>, stats array<long>"


def _counted(key: tuple, rows: pa.Table) -> pa.Table:
    """A part of an order: its table, its counts of counts, and an answer to each block."""
    kind, part = key[0].as_py(), key[1].as_py()
    rows = rows.sort_by("block")
    blocks, bodies = rows.column("block").to_pylist(), [_unpack(b) for b in rows.column("body").to_pylist()]
    keys = [np.cumsum(b[0], dtype=np.uint64) for b in bodies]
    distinct, total, at = _sums(keys, [b[1] for b in bodies])
    total = total.astype(np.int64)
    learnt = total > 0
    of = total[learnt & (distinct != np.uint64(_MARKS[BEGIN]))]
    stats = [int(of.sum()), len(of), *(int((of == r).sum()) for r in range(1, K + 2))]
    out = [(f"counts{kind}", 0, part, None, distinct[learnt].view(np.int64), total[learnt], None), (f"stats{kind}", 0, part, None, None, None, stats)]
    fresh = learnt.copy()
    for block, body, where in zip(blocks, bodies, at):
        mine = (body[1] > 0) & fresh[where]  # the first block that learnt a pair sums its share for the back-off weight
        fresh[where[mine]] = False
        out.append((f"answers{kind}", block, part, _pack(_small(total[where]), mine.view(np.uint8)), None, None, None))
    kinds = _COUNTED.set(4, pa.field("keys", pa.list_(pa.int64())))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)


def discounts(stats: list[int]) -> np.ndarray:
    """d_0..d_K of Katz from [N, V, n_1, ..., n_(K+1)]; the largest k up to K whose discounts are all in (0, 1)."""
    n = dict(enumerate(stats[2:], 1))
    for k in range(K, 0, -1):
        if n[1] and all(n[r] for r in range(1, k + 2)) and (rest := 1 - (k + 1) * n[k + 1] / n[1]) > 0:
            d = [((r + 1) * n[r + 1] / (r * n[r]) - (k + 1) * n[k + 1] / n[1]) / rest for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([0, *d, *[1.0] * (K - k)])
    return np.array([0, 0.5, *[1.0] * (K - 1)])


class Singles:
    """P(w) by count."""

    def __init__(self, stats: list[int]):
        self.n, self.v, self.d = stats[0], stats[1], discounts(stats)
        kept = sum(r * m * d for r, (m, d) in enumerate(
            zip(stats[2:], self.d[1:]),
            1,
        )) + self.n - sum(r * m for r, m in enumerate(stats[2 : 2 + K], 1))
        self.rest = 1 - kept / self.n if self.n else 1.0
        self.spare = self.rest < 1e-9  # no count was lowered: one more token stands for all others
        if self.spare:
            self.rest = 1 / (self.n + 1)

    def __call__(self, count: np.ndarray) -> np.ndarray:
        d = self.d[np.minimum(count, K)] * (count <= K) + (count > K)
        p = count / (self.n + 1) if self.spare else d * count / max(1, self.n)
        return np.where(count > 0, p, self.rest)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.n + 0.1 * (self.v + 1)))


def _ordered(rows: pa.Table, kind: str) -> list[list[np.ndarray]]:
    mine = rows.filter(pa.compute.equal(rows.column("kind"), kind)).sort_by("part")
    return [_unpack(b) for b in mine.column("body").to_pylist()]


def _joined(bodies: list[list[np.ndarray]], k: int) -> np.ndarray:
    """The k-th arrays of bodies, one behind the other; there may be none, as in a block of texts too short for a run."""
    return np.concatenate([x[k] for x in bodies]) if bodies else np.zeros(0)


def _count(history: np.ndarray) -> np.ndarray:
    """Counts of histories, with RESERVE where it may be needed."""
    return history + np.where(history > K, RESERVE, 0)


def _first_round(stats: list[list[int]], parts: int):
    order, single, discount = len(stats), Singles(stats[0]), [np.append(discounts(x), 1.0) for x in stats]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """A block with its counts: shares of back-off weights, and all of its scores but these weights."""
        block = key[0].as_py()
        ids, null, held, lens, tokens = _ordered(rows, "text")[0]
        hashes = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in _ordered(rows, "1")])
        runs, counts, chance, out = _runs(tokens, hashes, order), [], [], []
        for n, own in enumerate(runs):
            answers = _ordered(rows, f"answers{n + 1}")
            count = _joined(answers, 0).astype(np.int64)[own.rank]
            if n == 0:
                p = single(count)
            else:
                p = discount[n][np.minimum(count, K + 1)] * count / np.maximum(_count(counts[-1][own.history]), 1)
                mine = _joined(answers, 1).astype(bool)[own.rank]
                below = runs[n - 1]
                share = lambda x, h=own.history[mine], b=below: np.bincount(h, x, len(b.keys))[b.order]
                seen, low = share(p[mine]), share(chance[-1][own.lower[mine]])  # what is learnt is learnt in every lower order, too
                cut = _cuts(below.keys, parts)
                out += [(f"shares{n + 1}", block, k, _pack(seen[a:b], low[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            counts.append(count)
            chance.append(p)
        at = np.flatnonzero(tokens != _begin(hashes))
        doc = np.repeat(np.arange(len(lens), dtype=np.int32), lens)

        def evaluated(n: int, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
            """(logs of the probabilities of the tokens that are left, but for back-off weights; documents and histories of these, by order) from order n down."""
            if n == 0:
                return np.log10(chance[0][tokens[at[left]]]), []
            run_of = runs[n].of[at[left]]
            known = run_of >= 0  # the block may have no run that long
            known[known] = counts[n][run_of[known]] > 0
            log = np.empty(len(left))
            log[known] = np.log10(chance[n][run_of[known]])
            log[~known], weights = evaluated(n - 1, left[~known])
            history = runs[n - 1].of[at[left] - 1]
            opened = ~known & (run_of >= 0)
            opened[opened] = counts[n - 1][history[opened]] > 0
            return log, [*weights, doc[left[opened]], runs[n - 1].rank[history[opened]]]

        log, weights = evaluated(order - 1, np.arange(len(at)))
        total = lambda x: np.bincount(doc, x, len(lens))
        word = tokens[at]
        out.append((
            "docs",
            block,
            0,
            _pack(ids, null, held, _small(lens), total(counts[0][word] > 0), total(single.base(counts[0])[word]), total(log), *map(_small, weights)),
        ))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _MESSAGE)], schema=_MESSAGE)

    return run


def _weights(key: tuple, rows: pa.Table) -> pa.Table:
    """A part of the histories of n - 1 words: alpha of each, and an answer to each block."""
    n, part = key[0].as_py(), key[1].as_py()
    asked = rows.filter(pa.compute.equal(rows.column("kind"), str(n - 1))).sort_by("block")
    shares = rows.filter(pa.compute.equal(rows.column("kind"), f"shares{n}")).sort_by("block")
    blocks = asked.column("block").to_pylist()
    keys = [np.cumsum(_unpack(b)[0], dtype=np.uint64) for b in asked.column("body").to_pylist()]
    sums = [_unpack(b) for b in shares.column("body").to_pylist()]
    _, seen, at = _sums(keys, [s[0] for s in sums])
    _, low, _ = _sums(keys, [s[1] for s in sums])
    alpha = (1 - seen) / np.maximum(1 - low, 1e-12)
    out = [(f"weights{n}", b, part, _pack(np.log10(np.maximum(alpha[where], 1e-300)))) for b, where in zip(blocks, at)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _MESSAGE)], schema=_MESSAGE)


def _second_round(n: int, order: int):
    kind = pa.schema([
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ids, null, held, lens, known, base, score, *weights = _ordered(rows, "docs")[0]
        for k, (doc, history) in enumerate(zip(weights[::2], weights[1::2]), 2):
            log = _joined(_ordered(rows, f"weights{k}"), 0)
            score = score + np.bincount(doc, log[history], len(lens))
        held = held.astype(bool) & (null == 0)
        return pa.Table.from_arrays(
            [
                pa.array(ids, mask=null.astype(bool)),
                pa.array(held),
                pa.array(lens.astype(np.int64)),
                pa.array(known.astype(np.int64)),
                pa.array(np.full(len(lens), n)),
                pa.array(base),
                pa.array(score),
            ],
            schema=kind,
        )

    return run


def scored(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, parts: int | None = None, order: int = ORDER) -> DataFrame:
    """Scores of all documents by the model of those whose `held` is false.  docs: doc_id, text, held.

    parts: of the model's tables; by default as many as shuffle partitions, so a part stays as large as a shuffle partition should be.
    """
    spark = docs.sparkSession
    parts = parts or max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write = lambda rows, path: rows.write.option("compression", "none").partitionBy("kind").parquet(path)  # noqa: E731  bodies are compressed already
    asked, counts, shares = (new_path(spark, f"katz-{x}") for x in ("asked", "counts", "shares"))
    # blocks are numbered by task, so each partition of the documents must be a task of its own here
    write(arrow_map(docs.select("doc_id", "text", "held"), _asking(parts, block_tokens, order), MESSAGE), asked)
    ask = lambda *kinds: spark.read.schema(MESSAGE).parquet(asked).filter(F.col("kind").isin(*kinds))
    orders = [str(n) for n in range(1, order + 1)]
    for turn in range(TURNS):
        counted = arrow_groups(ask(*orders).filter(F.col("part") % TURNS == turn).groupBy("kind", "part"), _counted, COUNTED)
        in_files(counted).write.mode("append").option("compression", "zstd").option(
            "parquet.writer.version",
            "PARQUET_2_0",
        ).partitionBy("kind").parquet(counts)
        settled(spark)
    count = spark.read.schema(COUNTED).parquet(counts)
    found: dict[str, list[int]] = {}
    for row in count.filter(F.col("kind").startswith("stats")).groupBy("kind").agg(*(F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 3))).collect():
        found[row[0]] = list(row[1:])
    stats = [found.get(f"stats{n}", [0] * (K + 3)) for n in orders]
    if order > 1:
        dropped(spark, f"{asked}/kind={order}")  # no history is as long
    settled(spark)
    columns = ["kind", "block", "part", "body"]
    first = ask("text", "1").unionByName(count.filter(F.col("kind").isin(*(f"answers{n}" for n in orders))).select(*columns))
    write(in_files(arrow_groups(first.groupBy("block"), _first_round(stats, parts), MESSAGE)), shares)
    for done in (f"{asked}/kind=text", *(f"{counts}/kind=answers{n}" for n in orders)):
        dropped(spark, done)
    settled(spark)
    share = spark.read.schema(MESSAGE).parquet(shares)
    histories = ask(*orders[:-1]).withColumn(
        "n",
        F.col("kind").cast("int") + 1,
    ).unionByName(share.filter(F.col("kind").startswith("shares")).withColumn("n", F.substring("kind", 7, 9).cast("int")))
    weights = arrow_groups(histories.groupBy("n", "part"), _weights, MESSAGE)
    return arrow_groups(share.filter("kind = 'docs'").unionByName(weights).groupBy("block"), _second_round(stats[0][0], order), SCORES)


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by the model of those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 10) == 0
    return scored(docs.select("doc_id", "text", F.coalesce(held, F.lit(True)).alias("held")))
