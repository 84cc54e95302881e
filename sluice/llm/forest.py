"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are lifted onto a sphere (one more component makes all lengths equal,
so the largest inner product is the smallest angle), and each tree hashes them
to strings of BITS signs of random projections.  A tree is the sorted array of
its strings: the node that a prefix stands for is a run of it.  A query goes
down each tree to its own longest match, found by bisection, however long that
is in each; then all trees are climbed together, one letter at a time, and at
each level the runs of the trees whose match is as long join the candidates,
until there are enough distinct ones, which are scored exactly.

What is enough is not a guess: each shard of the index finds, by up to PROBES
of its own vectors whose true neighbours it knows, the fewest candidates at
which queries that stop there reach a recall of RECALL.  On clustered data
that is a few times k; on data without any structure it is most of a shard, as
no prefix tells neighbours from others there.

The index is dealt over shards by a hash of the id, so copies of a vector,
however many, are dealt over all shards; each block of queries meets each
shard, and the best k of each pair of them are merged.  Blocks and shards are
as large as a worker's memory allows, so that few copies of either are made;
still their number grows with queries times vectors.

Nulls and others: vectors that are null, empty, all zeros or hold null, NaN or
infinite components take no part, nor do rows without an id; vectors meet only
those of as many components.  Equal scores go to the smaller id; repeated ids
are repeated candidates, except that a query never meets its own id.  An empty
table gives no rows.  Other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.batches import arrow_groups, table

TREES, BITS, SHARD_ROWS, BLOCK_ROWS, PROBES, RECALL, SEED = 32, 32, 16384, 4096, 64, 0.95, 11
#: Queries that a shard answers at once.
TOGETHER = 128
FOUND = "query_id long, vec_id long, score double"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (array<double>) of the vectors that take part."""
    good = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x != 0)"
    return vectors.filter(good).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def _strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """A column a tree: the hash strings, first letter in the highest bit."""
    planes = np.random.default_rng(SEED).normal(size=(x.shape[1], trees * bits))
    signs = (x @ planes > 0).reshape(len(x), trees, bits)
    return (signs * (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64))).sum(2, dtype=np.uint64)


class Forest:
    """Sorted arrays of the strings of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int = TREES, bits: int = BITS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.trees, self.bits = ids[order], x[order], trees, bits
        norms = np.sqrt((self.x**2).sum(1))
        self.radius = norms.max()
        lifted = np.column_stack([self.x, np.sqrt(np.maximum(self.radius**2 - norms**2, 0))])
        strings = _strings(lifted, trees, bits)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def strings(self, q: np.ndarray) -> np.ndarray:
        """Of queries, which are lifted with a last component of 0."""
        return _strings(np.column_stack([q, np.zeros(len(q))]), self.trees, self.bits)

    def runs(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs of equal prefixes begin and end, a column a tree."""
        low = strings >> np.uint64(self.bits - depth) << np.uint64(self.bits - depth)
        high = low | np.uint64((1 << (self.bits - depth)) - 1)
        a, b = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(self.trees):
            a[:, t], b[:, t] = np.searchsorted(self.sorted[:, t], low[:, t], "left"), np.searchsorted(self.sorted[:, t], high[:, t], "right")
        return a, b

    def matches(self, strings: np.ndarray) -> np.ndarray:
        """The length of each query's longest match in each tree, by bisection: it is beside where the string belongs."""
        out = np.empty(strings.shape, np.int64)
        for t in range(self.trees):
            own, s = self.sorted[:, t], strings[:, t]
            at = np.searchsorted(own, s)
            apart = np.minimum(own[np.minimum(at, len(own) - 1)] ^ s, own[np.maximum(at - 1, 0)] ^ s)
            out[:, t] = self.bits - np.frexp(apart.astype(np.float64))[1]
        return out

    def levels(self, strings: np.ndarray, enough: int):
        """(level, rows of queries, which vectors are their candidates) from the longest matches up, all trees together; a query goes on until it has `enough`."""
        longest = self.matches(strings)
        open_ = np.arange(len(strings))
        inside = np.zeros((len(strings), len(self.ids)), bool)
        for level in range(int(longest.max(initial=0)), -1, -1):
            a, b = self.runs(strings[open_], level)
            b = np.where(longest[open_] >= level, b, a)
            ready = np.flatnonzero((b - a).sum(1) >= min(enough, len(self.ids)))  # with fewer in all runs there can't be as many distinct ones
            for i in ready:
                row = inside[open_[i]]
                for t in np.flatnonzero(b[i] > a[i]):
                    row[self.order[a[i, t] : b[i, t], t]] = True
            done = ready[inside[open_[ready]].sum(1) >= min(enough, len(self.ids))]
            if level == 0:
                done = np.arange(len(open_))
            if len(done):
                yield level, open_[done], inside[open_[done]]
                open_ = np.delete(open_, done)
            if not len(open_):
                return

    def enough(self, k: int, probes: int = PROBES, recall: float = RECALL) -> int:
        """The fewest candidates at which probes that stop there find their k nearest well enough."""
        pick = np.unique(np.linspace(0, len(self.ids) - 1, min(probes, len(self.ids))).astype(int))
        q = self.x[pick]
        score = q @ self.x.T
        score[np.arange(len(pick)), pick] = -np.inf
        k = min(k, len(self.ids) - 1)
        if k < 1:
            return 1
        top, strings = np.argpartition(-score, k - 1, axis=1)[:, :k], self.strings(q)
        low, high = k + 1, len(self.ids)
        while low < high:  # recall grows with the number
            middle = (low + high) // 2
            found = np.zeros(len(pick))
            for _, rows, inside in self.levels(strings, middle):
                found[rows] = np.take_along_axis(inside, top[rows], axis=1).mean(1)
            low, high = (low, middle) if found.mean() >= recall else (middle + 1, high)
        return low

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, enough: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the best k of each query's candidates, and how many candidates each had."""
        out, numbers = [], np.zeros(len(q), np.int64)
        for first in range(0, len(q), TOGETHER):
            block = slice(first, first + TOGETHER)
            for _, rows, inside in self.levels(self.strings(q[block]), max(enough, k + 1)):
                rows = rows + first
                inside &= self.ids[None, :] != query_ids[rows][:, None]
                numbers[rows] = inside.sum(1)
                score = q[rows] @ self.x.T if inside.mean() > 0.1 else None
                for i, row in enumerate(rows):
                    at = np.flatnonzero(inside[i])
                    rough = score[i, at] if score is not None else self.x[at] @ q[row]
                    if len(at) > k:
                        least = np.partition(rough, -k)[-k]
                        at = at[rough >= least - 1e-9 * (1 + abs(least))]
                    exact = (self.x[at] * q[row]).sum(1)  # the same for equal vectors wherever they stand
                    best = np.lexsort((self.ids[at], -exact))[:k]
                    out.append((np.full(len(best), query_ids[row]), self.ids[at][best], exact[best]))
        found = tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return *found, numbers


def _search(k: int):
    def run(rows: pa.Table) -> pa.Table:
        asks = np.array(rows.column("ask").to_pylist(), bool)
        ids = rows.column("vec_id").to_numpy()
        x = np.array(rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), -1)
        if asks.all() or not asks.any():
            return _FOUND.empty_table()
        forest = Forest(ids[~asks], x[~asks])
        return pa.table(list(forest.search(ids[asks], x[asks], k, forest.enough(k))[:3]), schema=_FOUND)

    return run


def nearest(vectors: DataFrame, asking, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of each vector for which `asking` (a condition on vec_id) holds."""
    rows = usable(vectors)
    total, queries = rows.agg(F.count("*"), F.count(F.when(asking, 1))).head()
    shards, blocks = -(-total // shard_rows) or 1, -(-queries // block_rows) or 1
    part = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    index = rows.select("vec_id", "v", F.lit(False).alias("ask"), part(1, shards).alias("shard"), every(blocks).alias("block"))
    query = rows.filter(asking).select("vec_id", "v", F.lit(True).alias("ask"), every(shards).alias("shard"), part(2, blocks).alias("block"))
    found = arrow_groups(index.unionByName(query).withColumn("size", F.size("v")).groupBy("size", "shard", "block"), _search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
