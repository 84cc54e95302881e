"""Near-duplicate groups by ProbMinHash signatures, banding and verification.

Texts become sets of SHINGLE successive words, weighted by how often each
comes, up to HEAVIEST times the weight of one that comes once.  Each shingle
is a Poisson process whose rate is its weight; its arrivals fall on random
registers, and a register keeps the shingle of its first arrival.  Two texts
agree in a register with the probability Jaccard similarity of their weights.
Arrivals come in order of time, so the process ends early: only arrivals up to
the time by which all registers are expected to be taken are drawn, and the
few texts with a register still empty go on to twice that time.

Equal texts are one node from the start.  Texts that agree in a band of ROWS
registers are candidates; every candidate pair that could join two groups is
verified: it is linked if the shingle sets (64-bit hashes) have a Jaccard
similarity of THRESHOLD or more.  Nothing but bounds of their
similarity, by sizes and prefixes, keeps a pair from being verified.

A bucket of equal bands never becomes all its pairs.  First each member is
compared with the bucket's leader, the member that meets most others, which
settles groups of copies however large.  What buckets still hold of different
groups is compared one by one in buckets of up to FEW members.  Members of
larger ones meet by their prefixes: a set's shingles in order of how rare they
are (by a table of SLOTS counts), of which two sets as alike as THRESHOLD must
share one of the first n - ceil(THRESHOLD n) + 1, early enough in both for
what follows it to make up the rest.  So boilerplate, which is common, brings
nobody together, and no pair is lost.  Buckets of a prefix
shingle with members of several groups are compared one by one or, when large,
in blocks of BLOCK members, which give only links that join groups.  Groups
are the connected components of the links.

Large buckets are dealt over up to SALTS parts by their members' ids in every
join by bucket, so none is a single task's.

Nulls, empty and long texts: a null text counts as empty; a text of fewer than
SHINGLE words is one shingle of all its words; an empty text has no shingle
and is grouped with equal ones only; long texts are read whole.  A group's id
is its smallest doc_id.  Rows with a null id get a row of their own, without a
group.  Repeated rows are copies of each other; rows that share an id count as
one document, with the links of all of them; an empty table gives no rows.
Other columns are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.batches import arrow_groups, arrow_map, gathered, held, table, text_slices, words
from sluice.llm.scratch import Scratch

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 24, 4
FEW, BLOCK, SALTS, SLOTS = 32, 128, 1024, 1 << 16
#: The weight of a shingle that comes very often.  It is near 1, so that repeats take little from the similarity by which texts become candidates.
HEAVIEST = 1.25
REGISTERS = BANDS * ROWS
_U, _S = np.uint64, np.float64(2.0**-53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1) * _S


def shingles(start: np.ndarray, code: np.ndarray, hashes: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, how often) of each distinct shingle, by text and then by hash."""
    n = np.diff(start)
    h = hashes[code]
    doc = np.repeat(np.arange(len(n)), n)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.repeat(start[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    of = np.repeat(np.arange(len(n)), count)
    length = np.minimum(n, size)[of]
    value = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            here = length > k
            value[here] = _mix(value[here] * _U(0x9E3779B97F4A7C15) + h[first[here] + k])
    del doc
    order = np.lexsort((value, of))
    of, value = of[order], value[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return of[at], value[at], np.diff(np.append(at, len(of)))


def weigh(times: np.ndarray) -> np.ndarray:
    """A shingle's weight by how often it comes."""
    return np.minimum(1 + np.log(times) / 16, HEAVIEST)


def signatures(of: np.ndarray, value: np.ndarray, times: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """A row of shingle hashes per text; a text without shingles has zeros."""
    weight = weigh(times)
    total = np.bincount(of, weight, n)
    out = np.zeros((n, registers), np.uint64)
    open_ = total > 0
    limit = registers * (np.log(registers) + 2) / np.maximum(total, 1e-300)
    with np.errstate(over="ignore"):
        while open_.any():
            mine = np.flatnonzero(open_[of])
            state = _mix(value[mine] + _U(0x2545F4914F6CDD1D))
            doc, key = of[mine], value[mine]
            time = np.zeros(len(mine))
            rate, end = weight[mine], limit[doc]
            docs, slots, arrivals, keys = [], [], [], []
            while len(doc):
                state = _mix(state + _U(0x9E3779B97F4A7C15))
                time = time - np.log(_uniform(state)) / rate
                go = time <= end
                doc, key, state, time, rate, end = (x[go] for x in (doc, key, state, time, rate, end))
                state = _mix(state + _U(0x9E3779B97F4A7C15))
                docs.append(doc)
                keys.append(key)
                arrivals.append(time)
                slots.append((state >> _U(32)) * _U(registers) >> _U(32))
            at = np.concatenate(docs) * registers + np.concatenate(slots).astype(np.int64)
            order = np.lexsort((np.concatenate(keys), np.concatenate(arrivals), at))
            at, key = at[order], np.concatenate(keys)[order]
            first = np.ones(len(at), bool)
            first[1:] = at[1:] != at[:-1]
            taken = at[first]
            full = np.bincount(taken // registers, minlength=n) == registers
            ready = full[taken // registers] & open_[taken // registers]
            out.reshape(-1)[taken[ready]] = key[first][ready]
            open_ &= ~full
            limit = limit * 2
    return out


def _shingled(batch: pa.RecordBatch):
    """(rows, start of each text's shingles and the end, their hashes, how often they come) of the slices of a batch."""
    names: dict[str, int] = held(("shingles",), dict)
    for rows, text in text_slices(batch, 2 << 20):
        start, code, distinct = words(text)
        if len(names) + len(distinct) > 400_000:
            names.clear()
        for w in distinct:
            if w not in names:
                names[w] = xxhash.xxh3_64_intdigest(w)
        of, value, times = shingles(start, code, np.fromiter(map(names.__getitem__, distinct), np.uint64, len(distinct)))
        yield rows, of, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(text)))]), value, times


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))


def _signed(batches):
    for batch in batches:
        for rows, of, cut, value, times in _shingled(batch):
            n, size = len(cut) - 1, np.diff(cut)
            sign = signatures(of, value, times, n)
            with np.errstate(over="ignore"):
                band = np.zeros((n, BANDS), np.uint64)
                for r in range(ROWS):
                    band = _mix(band * _U(0x9E3779B97F4A7C15) + sign[:, r::ROWS])
                band = _mix(band + np.arange(BANDS, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("node"),
                    pa.array(size.astype(np.int32)),
                    _lists(np.where(size > 0, BANDS, 0), band[size > 0].reshape(-1).view(np.int64)),
                ],
                names=["node", "size", "bands"],
            )


def _sets(batches):
    for batch in batches:
        for rows, _, cut, value, _ in _shingled(batch):
            yield pa.RecordBatch.from_arrays([rows.column("node"), _lists(np.diff(cut), value.view(np.int64))], names=["node", "shingles"])


SIGNED, SETS = "node long, size int, bands array<long>", "node long, shingles array<long>"


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root of each node of the links (a, b): root is the smallest node that links lead to.

    A round gives each node the smallest root next to it, twice, and then its
    root's root, so a chain more than halves; rounds end when one changes
    nothing.  links: is read several times.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = both.select("a").distinct().select("a", F.col("a").alias("b"))  # a node is next to itself, too
    near = scratch.kept(both.unionByName(own), "near")

    def step(roots: DataFrame) -> DataFrame:
        seen = near.join(roots.select(F.col("node").alias("b"), "root"), "b")
        return seen.groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("root"),
            F.min(F.when(F.col("a") == F.col("b"), F.col("root"))).alias("before"),
        )

    roots = near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    while True:
        low = step(roots).select("node", "root", "before")
        next_ = step(low.select("node", "root")).select("node", "root")
        up = next_.select(F.col("node").alias("root"), F.col("root").alias("over"))
        jumped = next_.join(up, "root", "left").select("node", F.coalesce("over", "root").alias("root"))
        new = scratch.kept(jumped.join(low.select("node", "before"), "node"), "roots")
        if new.filter("root != before").limit(1).count() == 0:
            return new.select("node", "root")
        roots = new.select("node", "root")


def _sized(a: str, b: str, threshold: float):
    """Whether sets of two sizes can be as alike as the threshold."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b, similarity of the pairs that are alike."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    found = pairs.join(left, "a").join(right, "b").select("a", "b", (both / (F.size("_x") + F.size("_y") - both)).alias("similarity"))
    return found.filter(F.col("similarity") >= threshold)


def _prefixes(weights: np.ndarray, threshold: float):
    """node, root, size, key and pos: the rarest shingles of each set, one of which any set as alike must share with it, and their places."""

    def rows(batches):
        for batch in batches:
            lists = batch.column("shingles")
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, of = lists.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(size)), size)
            order = np.lexsort((flat, weights[(flat % _U(len(weights))).astype(np.int64)], of))
            most = size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1
            pos = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            first = pos < most[of]
            at = of[first]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(at)),
                    batch.column("root").take(pa.array(at)),
                    pa.array(size[at].astype(np.int32)),
                    pa.array(flat[order][first].view(np.int64)),
                    pa.array(pos[first].astype(np.int32)),
                ],
                names=["node", "root", "size", "key", "pos"],
            )

    return rows


def _blocks(threshold: float):
    """Links that join unlike groups, verified where their members stand; pairs that the block's links join already are passed over."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(rows: pa.Table) -> pa.Table:
        node, root, asks, rest, pos = (rows.column(c).to_numpy() for c in ("node", "root", "asks", "rest", "pos"))
        flat = rows.column("shingles").combine_chunks().flatten().to_numpy().view(np.uint64)
        cut = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(rows.column("shingles")).to_numpy())])
        size, root, out = np.diff(cut), root.copy(), []
        for x in np.flatnonzero(asks):
            y = np.flatnonzero(~asks & (root != root[x]) & (~rest | (node > node[x])))  # two rest members meet once
            y = y[np.minimum(size[y], size[x]) >= threshold * np.maximum(size[y], size[x])]
            y = y[np.minimum(size[y] - pos[y], size[x] - pos[x]) >= threshold / (1 + threshold) * (size[y] + size[x]) - 1e-9]
            if not len(y):
                continue
            own = flat[cut[x] : cut[x + 1]]
            theirs = gathered(cut[y], size[y], flat)
            hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(hit, np.cumsum(size[y]) - size[y], dtype=np.int64)
            alike = both / (size[x] + size[y] - both)
            for k in np.flatnonzero(alike >= threshold):
                if root[y[k]] != root[x]:
                    out.append((min(node[x], node[y[k]]), max(node[x], node[y[k]]), alike[k]))
                    root[root == root[y[k]]] = root[x]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), kind)] if out else [pa.array([], f.type) for f in kind], schema=kind)

    return run


def _mixed(rooted: DataFrame, by: list[str]) -> DataFrame:
    """Buckets with members of several groups: how many members, how many outside the largest group (r), and that group (major)."""
    shares = rooted.groupBy(*by, "root").agg(F.count("*").alias("_m"))
    found = shares.groupBy(*by).agg(
        F.count("*").alias("_roots"),
        F.sum("_m").alias("n"),
        F.max("_m").alias("_most"),
        F.max_by("root", F.struct("_m", "root")).alias("major"),
    )
    return found.filter("_roots > 1").select(*by, "n", "major", (F.col("n") - F.col("_most")).alias("r"))


def _one_by_one(few: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """a, b: the pairs of different groups in buckets of few members; where sets' elements come after pos at most, those that have enough of them."""
    after = F.col("size") - F.col("pos") if "pos" in few.columns else F.col("size")
    left, right = (few.select(
        *by,
        F.col("node").alias(x),
        F.col("root").alias(f"_{x}"),
        F.col("size").alias(f"_size_{x}"),
        after.alias(f"_after_{x}"),
    ) for x in "ab")
    enough = F.least("_after_a", "_after_b") >= threshold / (1 + threshold) * (F.col("_size_a") + F.col("_size_b")) - 1e-9
    return left.join(right, by).filter("a < b AND _a != _b").filter(_sized("_size_a", "_size_b", threshold) & enough).select("a", "b").distinct()


def _by_prefix(many: DataFrame, sets: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """a, b, similarity: links that join different groups among the nodes of many (node, root)."""
    spark = many.sparkSession
    own = scratch.kept(sets.join(many.select("node", "root").distinct(), "node"), "own")
    slot = F.pmod("shingle", F.lit(SLOTS)).cast("int")
    counts = np.zeros(SLOTS, np.int64)
    found = own.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).count().toArrow()  # SLOTS rows at most
    counts[found.column("slot").to_numpy()] = found.column("count").to_numpy()
    salted = scratch.kept(
        arrow_map(
            own,
            _prefixes(counts, threshold),
            "node long, root long, size int, key long, pos int",
        ).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))),
        "prefixes",
    )
    dealt = salted.select("key", "salt").distinct().join(  # a large bucket's salts, each with what there is to know of it
        _mixed(salted, ["key"]),
        "key",
    )
    open_ = scratch.kept(salted.join(dealt, ["key", "salt"]).drop("salt"), "open")
    near = _one_by_one(open_.filter(F.col("n") <= FEW), ["key"], threshold)
    large = open_.filter(F.col("n") > FEW).withColumn("rest", F.col("root") != F.col("major"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    block = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    asking = large.filter("rest").select(
        "key",
        block("r").alias("i"),
        every("n").alias("j"),
        "node",
        "root",
        "rest",
        "pos",
        F.lit(True).alias("asks"),
    )
    asked = large.select("key", every("r").alias("i"), block("n").alias("j"), "node", "root", "rest", "pos", F.lit(False).alias("asks"))
    far = arrow_groups(
        asking.unionByName(asked).join(own.select("node", "shingles"), "node").groupBy("key", "i", "j"),
        _blocks(threshold),
        "a long, b long, similarity double",
    )
    return scratch.kept(_verified(near, own, threshold), "near").unionByName(scratch.kept(far, "far"))


def links(single: DataFrame, texts: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, similarity: links between different texts that join all that are alike and share a band, not all links there are.

    single: node, size, bands of each text; texts: node, text.
    """
    by = ["band", "key"]
    bands = single.select("node", "size", F.pmod(F.xxhash64("node"), F.lit(SALTS)).alias("salt"), F.posexplode("bands").alias("band", "key"))
    shares = bands.groupBy(*by, "salt").agg(F.count("*").alias("_m"))
    sizes = shares.groupBy(*by).agg(F.sum("_m").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1")  # SALTS of them at most
    members = scratch.kept(bands.join(sizes.select(*by, "n", F.explode("salts").alias("salt")), [*by, "salt"]), "members")
    salts = members.select(*by, "salt").distinct()  # of each bucket
    sets = scratch.kept(arrow_map(texts.join(members.select("node").distinct(), "node", "left_semi"), _sets, SETS), "sets")
    # the member that meets most others leads: the text that copies were made from is alike to more of them than they are to each other
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    leaders = members.join(degree, "node").groupBy(*by).agg(F.max_by(F.struct("node", "size"), F.struct("degree", -F.col("node"))).alias("leader"))
    led = members.join(salts.join(leaders, by), [*by, "salt"]).filter("node != leader.node").filter(_sized("size", "leader.size", threshold))
    led = scratch.kept(led.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct(), "led")
    first = scratch.kept(_verified(led, sets, threshold), "links")
    rooted = scratch.kept(members.drop("n").join(components(first, scratch), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    open_ = scratch.kept(rooted.join(salts.join(_mixed(rooted, by), by), [*by, "salt"]).drop("salt"), "open")
    second = scratch.kept(_verified(_one_by_one(open_.filter(F.col("n") <= FEW), by, threshold), sets, threshold), "second")
    many = open_.filter(F.col("n") > FEW)
    far = _by_prefix(many, sets, threshold, scratch)
    return first.unionByName(second).unionByName(far)


def grouped(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, copy_of and group_id of each document.

    copy_of is the smallest id with an equal text, group_id the smallest of
    its group.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("copy"))
    # each text once; copies are one before they are shuffled
    texts = scratch.kept(rows.filter("doc_id IS NOT NULL").groupBy("copy").agg(F.min("doc_id").alias("node"), F.first("text").alias("text")), "texts")
    signed = scratch.kept(arrow_map(texts.select("node", "text"), _signed, SIGNED), "signed")
    found = links(signed.filter("size > 0"), texts.select("node", "text"), scratch, threshold)
    roots = components(found, scratch).withColumnRenamed("node", "copy_of")
    classes = scratch.last(texts.select("copy", F.col("node").alias("copy_of")).join(roots, "copy_of", "left"), "classes")
    # ids of a group that share a row's text come by the text's digest; rows without an id have none
    known = F.col("doc_id").isNotNull()
    return rows.join(classes, "copy", "left").select(
        "doc_id",
        F.when(known, F.col("copy_of")).alias("copy_of"),
        F.when(known, F.coalesce("root", "copy_of")).alias("group_id"),
    )


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose id is the smallest of their group; of rows with one id the first by text.  Rows without an id stay."""
    groups = grouped(docs, threshold)
    keep = groups.filter("doc_id = group_id").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.struct("*").alias("_row"))
    again = Window.partitionBy("_id").orderBy(F.col("_text").asc_nulls_first())  # in the join's own partitions
    found = named.join(keep, F.col("_id") == F.col("_kept")).withColumn("_n", F.row_number().over(again)).filter("_n = 1").select("_row.*")
    return found.unionByName(docs.filter(F.col("doc_id").isNull()))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its text and its near-duplicate group."""
    return grouped(table(spark, sf_dir, "documents"))
