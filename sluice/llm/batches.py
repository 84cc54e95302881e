"""Arrow helpers shared by the text operators.

Executors see texts as Arrow record batches.  A batch may hold very long
texts, so every operator walks it in slices of a bounded number of bytes;
words are found and numbered by Arrow's own kernels, so Python only touches
each distinct word of a slice once.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are held at once as words.
SLICE_BYTES = 4 << 20
#: Bytes of a group behind which memory is given back.
LARGE_GROUP = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % n


def text_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Row slices of a batch with about `limit` bytes of text; null texts become empty ones."""
    text = batch.column(batch.schema.get_field_index("text"))
    if text.null_count:
        text = pc.fill_null(text, "")
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a), text.slice(a, b - a)


def coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(start of each text's words and the end, the number of each word, the distinct words)."""
    flat = lists.flatten().dictionary_encode()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()


def spaced(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts cut at every space, newline included in the words."""
    return coded(pc.split_pattern(text, " "))


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words between ASCII white space, with A-Z in lower case; no empty words."""
    start, code, distinct = coded(pc.ascii_split_whitespace(pc.ascii_lower(text)))
    if "" in distinct:
        keep = code != distinct.index("")
        start = np.concatenate([[0], np.cumsum(keep)])[start]
        code = code[keep]
    return start, code, distinct


def gathered(flat_start: np.ndarray, flat_len: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + len], one behind the other."""
    if not len(flat_len):
        return flat[:0]
    ends = np.cumsum(flat_len)
    shift = np.repeat(flat_start - (ends - flat_len), flat_len)
    return flat[np.arange(ends[-1]) + shift]


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths of the lists, what they hold)."""
    return np.fromiter(map(len, lists), np.int64, len(lists)), np.fromiter((i for x in lists for i in x), np.int32)


class RunCache:
    """Arrays of ids by word, at most `limit` words; when full, those not met for longest go."""

    def __init__(self, limit: int = 300_000):
        self.limit, self.number, self.tick = limit, {}, 0
        self.used, self.start, self.length, self.last, self.flat = 0, np.zeros(
            0,
            np.int64,
        ), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _shrink(self) -> None:
        n = len(self.number)
        keep = self.last[:n] > np.partition(self.last[:n], n // 2)[n // 2]
        names = [w for w, k in zip(self.number, keep.tolist()) if k]
        self.flat = gathered(self.start[:n][keep], self.length[:n][keep], self.flat)
        self.length, self.last, self.used = self.length[:n][keep], self.last[:n][keep], len(self.flat)
        self.start = np.cumsum(self.length) - self.length
        self.number = dict(zip(names, range(len(names))))

    def _put(self, new: list[str], lens: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.number)
        total = int(lens.sum())
        if n + len(new) > len(self.start):
            grow = max(len(self.start) * 3 // 2, n + len(new))
            self.start, self.length, self.last = (np.resize(x, grow) for x in (self.start, self.length, self.last)) if n else np.zeros(
                (3, grow),
                np.int64,
            )
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(self.used // 2, total), np.int32)])
        self.start[n : n + len(new)] = self.used + np.cumsum(lens) - lens
        self.length[n : n + len(new)] = lens
        self.flat[self.used : self.used + total] = ids
        self.used += total
        self.number.update(zip(new, range(n, n + len(new))))

    def runs(self, distinct: list[str], code: np.ndarray, start: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """(start of each text's ids and the end, ids); make: (numbers of ids, ids) of words that are new."""
        if self.number and (len(self.number) + len(distinct) > self.limit or self.used > 16 * self.limit):
            self._shrink()
        if new := [w for w in distinct if w not in self.number]:
            self._put(new, *make(new))
        own = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        self.tick += 1
        self.last[own] = self.tick
        at = own[code]
        lens = self.length[at]
        return np.concatenate([[0], np.cumsum(lens)])[start], gathered(self.start[at], lens, self.flat)


_HELD: dict[tuple, object] = {}


def _thrifty(roomy: bool) -> None:
    """Has a worker give freed arrays back to the system where its C library can; roomy: large ones only, which takes less time."""
    with contextlib.suppress(OSError, AttributeError):
        c = ctypes.CDLL(None)
        mapped, top = (32, 64) if roomy else (4, 16)
        for option, value in ((-3, mapped << 20), (-1, top << 20), (-8, 1)):  # least size of a mapping of its own, most free memory at the top, arenas
            c.mallopt(option, value)
        pa.set_memory_pool(pa.system_memory_pool())


def let_go() -> None:
    """Gives what a process does not need any more back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def held(kind: tuple, make):
    """What a worker keeps from task to task, such as a model with its cache of words: one thing at a time, so that stages of a pipeline don't add up."""
    if kind not in _HELD:
        if _HELD:
            _HELD.clear()
            let_go()
        _HELD[kind] = make()
    return _HELD[kind]


def _begun(keeps: bool, roomy: bool = False) -> None:
    """Before a task or a group; keeps: whether what the worker holds may be of use for it."""
    _thrifty(roomy)
    if not keeps and _HELD:
        _HELD.clear()
        let_go()


def _lean_batches(function, roomy: bool):
    def batches(rows):
        _begun(True, roomy)
        yield from function(rows)
        let_go()

    return batches


def _lean_group(function):
    def group(rows):
        return keyed_group(rows)

    def keyed_group(*args):
        _begun(False)
        out = function(*args)
        if args[-1].nbytes > LARGE_GROUP:
            let_go()
        return out

    return (lambda key, rows: keyed_group(key, rows)) if function.__code__.co_argcount == 2 else group


def shipped(spark: SparkSession) -> None:
    """Sends this package to the executors, once a Spark context, unless their path has it."""
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if getattr(context, "_sluice_shipped", False) or str(top.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = Path(tempfile.mkdtemp()) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(str(path))
    context._sluice_shipped = True


def arrow_map(rows: DataFrame, function, schema, roomy: bool = False) -> DataFrame:
    """mapInArrow with this package on the executors; roomy: for functions that are short of time, not of memory."""
    shipped(rows.sparkSession)
    return rows.mapInArrow(_lean_batches(function, roomy), schema)


def arrow_groups(groups: GroupedData, function, schema: str) -> DataFrame:
    """applyInArrow with this package on the executors."""
    shipped(groups.session)
    return groups.applyInArrow(_lean_group(function), schema)
