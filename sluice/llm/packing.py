"""Best-fit packing by bin completion over a histogram of lengths.

Documents become ids once, in Arrow batches; only their pieces' lengths and
checksums go on.  Lengths are whole numbers up to the capacity, so everything
there is to pack is a histogram of at most `capacity` counts, however many
documents there are, and the driver packs that.

Around the largest length left stands the best-fit filling as incumbent.  If
it wastes more than it must, the undominated filling of least waste takes its
place: sums that shorter lengths can reach are sets of bits, which bound the
waste of every branch exactly, so the search walks straight to it.  Longest
pieces come first, so of all fillings of that waste it is the one in which no
piece or pieces could be swapped for a longer one (it is not dominated).  A
filling is repeated as often as the counts allow: each uses up a length or
leaves less of it than one filling needs, so fillings are few.

If that takes more sequences than the lower bound (whole capacity, and pieces
of more than half of it), the last TAIL sequences are packed anew by the whole
branch and bound: undominated fillings around the largest piece in order of
waste, pruned where the waste so far cannot save a sequence any more.  That
search ends after SEARCH fillings at the latest (packing is NP-hard); `Plan`
tells whether its number of sequences is proven to be the least.

Every piece finds its place from its rank among pieces of its length.  Ranks
are dealt over parts of PART pieces at least, as many as they are long when
there are many, with their counts summed before, and
places are joined by length and hundreds of ranks, so a length that a third of
all pieces have is no single task's.

Nulls, empty and long texts: a null text counts as empty and has the end id
alone; longer documents are cut into pieces of the capacity and a rest.
Repeated rows are packed as often as they come, equal lengths in order of
doc_id; an empty table gives no rows.  Other columns are never looked at.
"""

from __future__ import annotations

import json
import math
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.batches import RunCache, arrow_map, coded, flattened, gathered, held, table, text_slices
from sluice.llm.scratch import Scratch

CAPACITY, END_ID, PART, RANKS = 4096, 1, 512, 512
#: Sequences that are packed anew where the bound is not met, and fillings looked at for that.
TAIL, SEARCH = 64, 2000
#: Signs that the tokenizer always parts from letters before them, and takes together; an apostrophe may be of a word.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokenizer:
    """A tokenizers file whose words never go over white space, with a bounded cache of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        split = [x for x in kind["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        if not split or split[0]["behavior"] != "Removed" or "\\s" in split[0]["pattern"]["Regex"].replace("^\\s", ""):
            raise ValueError("words of this tokenizer may go over white space")
        self.marks = {"type": "Lowercase"} in kind["normalizer"]["normalizers"] and all(x["content"].startswith("<|") for x in kind["added_tokens"])
        suffix, vocabulary = kind["model"].get("end_of_word_suffix"), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word of letters
        self.ends[[i for w, i in vocabulary.items() if suffix and w.endswith(suffix)]] = True
        self.cache = RunCache(700_000)

    def _each(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str], together: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of words of letters: many are encoded as one text, and cut where words end."""
        lens, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for k in range(0, len(words), together):
            part = words[k : k + together]
            ids = np.array(self._each([" ".join(part)])[0], np.int32)
            n = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(n) != len(part) or n.sum() != len(ids):  # not every word is one of letters to the tokenizer
                n, ids = flattened(self._each(part))
            lens.append(n)
            flat.append(ids)
        return np.concatenate(lens), np.concatenate(flat)

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of words: signs behind letters are parted from them, so letters are encoded once with any signs."""
        plain = lambda x: x.to_numpy(zero_copy_only=False)
        whole = pa.array(words, pa.string())
        stem = pc.ascii_rtrim(whole, SIGNS)
        letters = plain(pc.utf8_is_alpha(stem))
        simple = np.flatnonzero(letters)
        coded_ = stem.take(pa.array(simple)).dictionary_encode()
        number = coded_.indices.to_numpy(zero_copy_only=False)
        stems, known = coded_.dictionary.to_pylist(), self.cache.number
        # other letters must be as they are when normalised, and stay one letter in lower case
        odd = [i for i, w in enumerate(stems) if not w.isascii() and ("\u0130" in w or not unicodedata.is_normalized("NFC", w))]
        if odd:
            good = ~np.isin(number, odd)
            letters[simple[~good]] = False
            simple, number = simple[good], number[good]
        others = np.flatnonzero(~letters)
        of = np.fromiter((known.get(w, -1) for w in stems), np.int64, len(stems))
        of[odd] = -2
        old, fresh = np.flatnonzero(of >= 0), np.flatnonzero(of == -1)
        new_lens, new_flat = self._letters([stems[i] for i in fresh.tolist()])
        other_lens, other_flat = flattened(self._each([words[i] for i in others.tolist()]))
        signed = simple[plain(pc.not_equal(whole, stem))[simple]]
        tails = pc.replace_substring_regex(whole.take(pa.array(signed)), r"^\pL+", "").dictionary_encode()
        tail_lens, tail_flat = flattened(self._each(tails.dictionary.to_pylist()))
        cached = of[old]
        flat = np.concatenate([gathered(self.cache.start[cached], self.cache.length[cached], self.cache.flat), new_flat, other_flat, tail_flat])
        lens = np.concatenate([self.cache.length[cached], new_lens, other_lens, tail_lens, [0]])
        start = np.cumsum(lens) - lens
        run = np.empty(len(stems), np.int64)  # where a stem is among the runs of flat
        run[old], run[fresh] = np.arange(len(old)), len(old) + np.arange(len(fresh))
        first, second = np.empty(len(words), np.int64), np.full(len(words), len(lens) - 1)
        first[simple] = run[number]
        first[others] = len(old) + len(fresh) + np.arange(len(others))
        second[signed] = len(old) + len(fresh) + len(others) + tails.indices.to_numpy(zero_copy_only=False)
        runs = np.column_stack([first, second]).ravel()
        return lens[runs].reshape(-1, 2).sum(1), gathered(start[runs], lens[runs], flat)

    def encode_all(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(start of each text's ids and the end, ids)."""
        # lower case and line ends are the tokenizer's own first steps, and make fewer distinct words; marks of special tokens are matched before them
        low = pc.if_else(pc.match_substring(text, "<|"), text, pc.ascii_lower(text)) if self.marks else text
        start, code, distinct = coded(pc.split_pattern(pc.replace_substring(low, "\n", " "), " "))
        return self.cache.runs(distinct, code, start, self._new)


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a path, once a worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(("words", path), lambda: WordTokenizer(path))


def _pieces(path: str, capacity: int, end_id: int):
    def rows(batches):
        tokenizer = word_tokenizer(path)
        kind = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for part, text in text_slices(batch):
                at, ids = tokenizer.encode_all(text)
                out: list[tuple] = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at.tolist(), at[1:].tolist()):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    out += [(
                        doc,
                        k,
                        s,
                        min(capacity, len(own) - s),
                        zlib.crc32(own[s : s + capacity].tobytes()),
                    ) for k, s in enumerate(range(0, len(own), capacity))]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind)], schema=kind)

    return rows


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of at most `capacity` ids."""
    return arrow_map(docs.select("doc_id", "text"), _pieces(path, capacity, end_id), PIECES, roomy=True)


def reaches(lengths: list[tuple[int, int]], room: int) -> list[int]:
    """For each k, as bits, the sums up to room that lengths[k:] (length, count) can make."""
    out, sums, mask = [1], 1, (1 << (room + 1)) - 1
    for length, count in reversed(lengths):
        n, step = min(count, room // length), 1
        while n > 0:  # counts by powers of two
            take = min(step, n)
            sums |= (sums << (take * length)) & mask
            n, step = n - take, step * 2
        out.append(sums)
    return out[::-1]


def undominated(counts: dict[int, int], room: int, most_waste: int) -> Iterator[tuple[int, list[int] | None]]:
    """(waste, lengths) of the fillings of room that waste up to most_waste, in order of waste and then longest pieces first.

    A filling is dominated, and None stands for it, if some of its pieces
    could be swapped for one longer piece that is left and fits.
    """
    lengths = sorted(((x, n) for x, n in counts.items() if n and x <= room), reverse=True)
    reach = reaches(lengths, room)

    def exact(k: int, target: int, chosen: list[int]) -> Iterator[list[int]]:
        if target == 0:
            yield chosen
        elif k < len(lengths):
            length, count = lengths[k]
            for n in range(min(count, target // length), -1, -1):
                if reach[k + 1] >> (target - n * length) & 1:
                    yield from exact(k + 1, target - n * length, chosen + [length] * n)

    def dominated(filling: list[int], waste: int) -> bool:
        sums = reaches([(x, 1) for x in filling], room)[0]
        for x, n in lengths:
            if n > filling.count(x):
                own = sums if x not in filling else reaches([(y, 1) for y in filling if y != x], room)[0]
                least = max(1, x - waste)
                if own >> least & ((1 << (x - least + 1)) - 1):
                    return True
        return False

    for waste in range(min(most_waste, room) + 1):
        if reach[0] >> (room - waste) & 1:
            for filling in exact(0, room - waste, []):
                yield waste, None if dominated(filling, waste) else filling


def best_fit(left: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The longest piece that fits, again and again.  lengths: in order."""
    out, used = [], {}
    while (k := bisect_right(lengths, room)) > 0:
        while k > 0 and left[lengths[k - 1]] <= used.get(lengths[k - 1], 0):
            k -= 1
        if k == 0:
            break
        x = lengths[k - 1]
        n = min(left[x] - used.get(x, 0), room // x)
        out += [x] * n
        used[x] = used.get(x, 0) + n
        room -= n * x
    return out


def complete(left: dict[int, int], room: int) -> list[int]:
    """The filling of room by lengths with counts: best fit if nothing can waste less, else the undominated one of least waste."""
    lengths = sorted(x for x, n in left.items() if n and x <= room)
    incumbent = best_fit(left, lengths, room)
    waste = room - sum(incumbent)
    if waste == 0 or len(incumbent) == sum(left[x] for x in lengths):  # nothing is left that fits
        return incumbent
    own = [(x, left[x]) for x in reversed(lengths)]
    reach = reaches(own, room)
    target = reach[0].bit_length() - 1  # the largest sum there is
    if room - target == waste:
        return incumbent
    out = []
    for k, (length, count) in enumerate(own):
        for n in range(min(count, target // length), -1, -1):
            if reach[k + 1] >> (target - n * length) & 1:
                out += [length] * n
                target -= n * length
                break
    return out


class Plan(NamedTuple):
    """How pieces go into sequences."""

    fillings: list[tuple[int, list[int]]]  # how often, lengths
    sequences: int
    bound: int  # no packing has fewer sequences
    proven: bool  # whether none with fewer sequences than this one exists


def _search(counts: dict[int, int], capacity: int, incumbent: int, bound: int, most: int) -> tuple[list[list[int]] | None, bool]:
    """(fillings of fewer sequences than the incumbent, or None; whether the search came to its end)."""
    best, tried = None, 0
    spare = lambda: (incumbent - 1) * capacity - total  # noqa: E731  waste that a packing which saves a sequence may have
    total = sum(x * n for x, n in counts.items())
    left, done, wasted = dict(counts), [], 0

    def choices(waste: int) -> Iterator[tuple[int, list[int] | None]]:
        largest = max(x for x, n in left.items() if n)
        rest = left | {largest: left[largest] - 1}
        return ((w, f and [largest, *f] if f != [] else [largest]) for w, f in undominated(rest, capacity - largest, spare() - waste))

    stack = [choices(0)]
    while stack:
        if tried >= most:
            return best, False
        found = next(stack[-1], None)
        if found is None or wasted + found[0] > spare():
            stack.pop()
            if done:
                w, filling = done.pop()
                wasted -= w
                for x in filling:
                    left[x] += 1
            continue
        tried += 1
        waste, filling = found
        if filling is None:
            continue
        for x in filling:
            left[x] -= 1
        if not any(left.values()):
            best, incumbent = [f for _, f in done] + [filling], len(done) + 1
            if incumbent <= bound:
                return best, True
            for x in filling:
                left[x] += 1
            continue
        done.append(found)
        wasted += waste
        stack.append(choices(wasted))
    return best, True


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by all tokens, or by the pieces that can't be two in one."""
    return max(-(-sum(x * n for x, n in counts.items()) // capacity), sum(n for x, n in counts.items() if 2 * x > capacity))


def fillings(counts: dict[int, int], capacity: int = CAPACITY, tail: int = TAIL, search: int = SEARCH) -> Plan:
    """The sequences that hold all counted pieces."""
    left = {x: n for x, n in sorted(counts.items()) if n}
    out: list[tuple[int, list[int]]] = []
    while left:
        largest = max(left)
        left[largest] -= 1
        filling = [largest, *complete(left, capacity - largest)]
        left[largest] += 1
        need = {x: filling.count(x) for x in set(filling)}
        times = min(left[x] // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((times, filling))
    sequences, bound = sum(n for n, _ in out), lower_bound(counts, capacity)
    proven = sequences <= bound
    if not proven:  # the last sequences anew, by the whole search
        anew: list[tuple[int, list[int]]] = []
        while out and (room := tail - sum(n for n, _ in anew)) > 0:
            times, filling = out.pop()
            anew.append((min(times, room), filling))
            if times > room:
                out.append((times - room, filling))
        pieces_: dict[int, int] = {}
        for n, filling in anew:
            for x in filling:
                pieces_[x] = pieces_.get(x, 0) + n
        now = sum(n for n, _ in anew)
        better, ended = _search(pieces_, capacity, now, lower_bound(pieces_, capacity), search)
        out += [(1, f) for f in better] if better else anew[::-1]
        sequences = sum(n for n, _ in out)
        proven = sequences <= bound or (ended and sum(n for n, _ in out[: -len(better or anew)]) == 0)
    return Plan(out, sequences, bound, proven)


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.  rows: is read several times."""
    spark = rows.sparkSession
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    plan: list[tuple[int, int, int, int, int]] = []  # length, first rank, places in a sequence before it, first sequence, offset
    given: dict[int, int] = {}
    first = 0
    for times, filling in fillings(counts, capacity).fillings:
        offset = 0
        for length in filling:
            plan.append((length, given.get(length, 0), times, first, offset))
            given[length] = given.get(length, 0) + times
            offset += length
        first += times
    columns = [np.array(c, np.int64) for c in zip(*plan)] or [np.zeros(0, np.int64)] * 5
    slots = spark.createDataFrame(pa.table(columns, names=["length", "_first", "_times", "_sequence", "offset"]))
    near = lambda rank: F.floor(rank / RANKS)
    slots = slots.withColumn("_near", F.explode(F.sequence(near(F.col("_first")), near(F.col("_first") + F.col("_times") - 1))))
    parts = spark.createDataFrame(pa.table(
        [np.array(list(counts), np.int64), np.array([min(-(-n // PART), math.isqrt(n) + 1) for n in counts.values()], np.int64)],
        names=["length", "_parts"],
    ))
    dealt = rows.join(F.broadcast(parts), "length").withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_parts")))  # `capacity` rows
    sums = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = sums.select("length", "_part", (F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    own = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(own) - 1).join(before, ["length", "_part"]).withColumn(
        "_rank",
        F.col("_rank") + F.col("_before"),
    )
    found = ranked.withColumn("_near", near(F.col("_rank"))).join(slots, ["length", "_near"]).filter("_rank >= _first AND _rank < _first + _times")
    return found.select(*rows.columns, (F.col("_sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"), "offset")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each piece of each document with its sequence and its place there."""
    scratch = Scratch(docs.sparkSession, "packing")
    return scratch.last(placed(scratch.kept(pieces(docs, path, capacity, end_id), "pieces"), capacity), "packed")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 4096 tokens."""
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
