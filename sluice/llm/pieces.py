"""Encoding and decoding with a merge-type sentencepiece vocabulary.

The encoder keeps an agenda (a heap) of adjacent symbol pairs whose union is a
piece, best score first and leftmost among equals, merges the best and puts
the two new pairs on the agenda, until it is empty.  Symbols that are no piece
fall back to bytes.  No piece has a space mark behind another character, so a
text falls apart at every run of spaces without any change to its merges, and
each worker encodes a distinct run-and-word once and keeps it in a bounded
cache.  The runs of a batch that are new are also encoded by the sentencepiece
library, and a text agrees if all its runs came out the same (column agrees).

Nulls, empty and long texts: a null text counts as empty; an empty text has
the begin and end ids alone; long texts are encoded whole.  Repeated rows give
repeated results; an empty table gives none.  Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import re
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.batches import RunCache, arrow_map, coded, flattened, held, table, text_slices

MARK, LINE_END = "▁", "\n"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"


class PieceModel:
    """Pieces and scores of a model file, with the merge encoder over them."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: lib.get_score(i) for i in plain}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character")
        self.lines = not any(LINE_END in p for p in self.ids)
        self.known: dict[str, list[int]] = {}
        self.wrong: set[str] = set()
        self.cache = RunCache(700_000)
        self.runs = re.compile(f"{MARK}+[^{MARK}]*")

    def encode(self, chunk: str) -> list[int]:
        """Ids of a chunk whose spaces are marks already; no piece goes over the end of a line."""
        if "\n" not in chunk or not self.lines:
            return self._merged(chunk)
        out: list[int] = []
        for i, line in enumerate(chunk.split("\n")):
            if i:
                out += self._line(LINE_END)
            if line:
                out += self._line(line)
        return out

    def _line(self, line: str) -> list[int]:
        if (ids := self.known.get(line)) is None:
            if len(self.known) >= 100_000:
                self.known.clear()
            ids = self.known[line] = self._merged(line)
        return ids

    def _merged(self, chunk: str) -> list[int]:
        part = list(chunk)
        n, scores = len(part), self.scores
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(-scores[s], i, s) for i in range(n - 1) if (s := part[i] + part[i + 1]) in scores]
        heapify(agenda)
        while agenda:
            _, i, joined = heappop(agenda)
            if part[i] is None or (j := after[i]) >= n or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := joined + part[k]) in scores:
                    heappush(agenda, (-scores[s], i, s))
            if (h := before[i]) >= 0 and (s := part[h] + joined) in scores:
                heappush(agenda, (-scores[s], h, s))
        out: list[int] = []
        for p in part:
            if p is not None:
                if p in self.ids:
                    out.append(self.ids[p])
                elif self.byte:
                    out += [self.byte[b] for b in p.encode()]
                else:
                    out.append(self.unk)
        return out

    def encode_all(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of each text's ids and the end, ids, whether the library agrees), without begin and end ids."""
        marked = pc.replace_substring(text, " ", MARK)
        # a space mark before a word is cut off with it; runs of marks are rare and stay with the word behind them
        odd = pc.or_(
            pc.match_substring(marked, MARK * 2),
            pc.or_(pc.starts_with(marked, MARK), pc.ends_with(marked, MARK)),
        ).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(marked, MARK)
        if odd.any():
            plain = lists.to_pylist()
            for i in np.flatnonzero(odd):
                plain[i] = [r[1:] for r in self.runs.findall(MARK + marked[i].as_py())]
            lists = pa.array(plain, pa.list_(pa.string()))
        empty = pc.equal(marked, "").to_numpy(zero_copy_only=False)
        start, code, distinct = coded(lists)
        at, ids = self.cache.runs(distinct, code, start, self._new_runs)
        agrees = np.ones(len(text), bool)
        if self.wrong:
            agrees[np.searchsorted(start, np.flatnonzero(np.isin(code, [i for i, w in enumerate(distinct) if w in self.wrong])), "right") - 1] = False
        if empty.any():  # no words at all, not one empty word
            lens = np.diff(at)
            keep = np.repeat(~empty, lens)
            ids, at = ids[keep], np.concatenate([[0], np.cumsum(np.where(empty, 0, lens))])
        return at, ids, agrees

    def _new_runs(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of new runs, which are checked against the library's; its own begin mark stands for the first."""
        own = [self.encode(MARK + w) for w in new]
        self.wrong.update(w for w, x, y in zip(new, own, self.library.encode(new, num_threads=1)) if w and x != y)
        return flattened(own)

    def decode(self, ids: list[int]) -> str:
        """The text of ids by the library."""
        return self.library.decode(ids)


def piece_model(path: str) -> PieceModel:
    """The model of a path, once a worker."""
    return held(("pieces", path), lambda: PieceModel(path))


def _rows(path: str):
    def rows(batches):
        model = piece_model(path)
        kind = pa.schema([
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_sha256", pa.string()),
            ("decoded_sha256", pa.string()),
            ("agrees", pa.bool_()),
        ])
        for batch in batches:
            for part, text in text_slices(batch):
                at, ids, agrees = model.encode_all(text)
                own = [[model.bos, *ids[a:b].tolist(), model.eos] for a, b in zip(at, at[1:])]
                sha = [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in own]
                back = [hashlib.sha256(t.encode()).hexdigest() for t in model.library.decode(own)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array(sha, pa.string()),
                        pa.array(back, pa.string()),
                        pa.array(agrees, pa.bool_()),
                    ],
                    schema=kind,
                )

    return rows


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """A row per document: number and digest of its ids, digest of the text decoded from them, and whether the library's ids are the same."""
    return arrow_map(docs.select("doc_id", "text"), _rows(path), SCHEMA)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of the text decoded from them."""
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
