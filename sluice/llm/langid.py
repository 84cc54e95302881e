"""Language identification by unigrams with marginalised segmentation.

Every language has a probability for every piece of a fixed public vocabulary
that can occur in lower case (pieces with capitals never match).
A word's probability is the sum over all its segmentations into pieces, which
the forward algorithm gives without listing them; a text's is the product over
its words (runs of letters behind a begin mark, in lower case).  The piece
probabilities are fitted by expectation maximisation over the same lattices.

Fitting takes at most about SAMPLE_DOCS labelled documents, evenly from each
language; everything else covers all rows.  Distinct words are scored once a
worker and kept in a bounded cache.

Nulls, empty and long texts: texts that are null, empty or without a letter
are `und` with score 0; long texts and long words are scored whole.  A null
language or id is not learnt from.  Repeated rows give repeated results; equal
scores go to the language first in the alphabet; an empty table gives no rows.
Other columns are never looked at.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import arrow_map, coded, held, remainder, table, text_slices
from sluice.llm.samples import sampled
from sluice.llm.scratch import settled

SAMPLE_DOCS, ROUNDS, LONGEST, MARK = 6000, 3, 16, "▁"
#: The probability of a character that the vocabulary lacks; words over LONG letters are scaled at each step.
UNKNOWN, LONG = 1e-7, 40
#: Each piece's probability is raised by this per letter, so that no word underflows; taken off again at the end.
RAISE = 50.0
CACHED = 600_000
FAR, LEAST_FAR, JUDGED, ENOUGH = 2.5, 1.5, 20, 50_000
RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def runs(word: str) -> list[str]:
    """The runs of letters of a word, in lower case."""
    return RUN.findall(word.lower())


def vocabulary(path: str) -> dict[str, int]:
    """Number of each ordinary piece of a model file, lower-case letters only; 0 stands for other characters."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    found = sorted({p for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)) and len(p := lib.id_to_piece(i)) <= LONGEST and p == p.lower()})
    return {p: i for i, p in enumerate(found, 1)}


class Lattices:
    """Words of equal length: for each end and length of a piece, the piece of every word, or -1."""

    def __init__(self, words: list[str], vocab: dict[str, int]):
        self.n = n = len(words[0])
        get = vocab.get
        self.spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - LONGEST), j)]
        flat = (get(w[i:j], -1) if j - i > 1 else get(w[i], 0) for w in words for i, j in self.spans)
        self.pieces = np.fromiter(
            flat,
            np.int16 if len(vocab) < 1 << 15 else np.int32,
            len(words) * len(self.spans),
        ).reshape(len(words), len(self.spans))
        self.used = np.flatnonzero((self.pieces >= 0).any(0))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of each prefix, a row a word; p: by piece, its last entry 0."""
        a = np.zeros((len(self.pieces), self.n + 1))
        a[:, 0] = 1
        for k in self.used:
            i, j = self.spans[k]
            a[:, j] += a[:, i] * p[self.pieces[:, k]] * RAISE ** (j - i)
        return a

    def expected(self, p: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected number of times that each piece is used."""
        a = self.forward(p)
        b = np.zeros_like(a)
        b[:, -1] = 1
        for k in self.used[::-1]:
            i, j = self.spans[k]
            b[:, i] += b[:, j] * p[self.pieces[:, k]] * RAISE ** (j - i)
        scale = weight / np.maximum(a[:, -1], 1e-300)
        for k in self.used:
            i, j = self.spans[k]
            np.add.at(out, self.pieces[:, k], scale * a[:, i] * p[self.pieces[:, k]] * RAISE ** (j - i) * b[:, j])


def _by_length(words: list[str], most: int = 5000) -> list[tuple[list[int], list[str]]]:
    groups: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    return [(at[a : a + most], [words[i] for i in at[a : a + most]]) for _, at in sorted(groups.items()) for a in range(0, len(at), most)]


class LongWord:
    """The lattice of a word that is too long for plain products: sums are logarithms."""

    def __init__(self, word: str, vocab: dict[str, int]):
        get = vocab.get
        self.n = len(word)
        self.pieces = np.full((self.n + 1, LONGEST), -1)  # by end and length - 1
        for j in range(1, self.n + 1):
            for back in range(1, min(LONGEST, j) + 1):
                self.pieces[j, back - 1] = get(word[j - back : j], 0 if back == 1 else -1)

    def expected(self, p: np.ndarray, weight: float, out: np.ndarray) -> None:
        """Adds the expected number of times that each piece is used."""
        log = np.where(self.pieces >= 0, np.log(np.maximum(p[self.pieces], 1e-300)), -np.inf)
        a, b = np.full(self.n + 1, -np.inf), np.full(self.n + 1, -np.inf)
        a[0] = b[self.n] = 0
        for j in range(1, self.n + 1):
            k = min(LONGEST, j)
            a[j] = np.logaddexp.reduce(a[j - 1 :: -1][:k] + log[j, :k])
        for j in range(self.n, 0, -1):
            k = min(LONGEST, j)
            b[j - k : j] = np.logaddexp(b[j - k : j], (b[j] + log[j, :k])[::-1])
        for j in range(1, self.n + 1):
            k = min(LONGEST, j)
            use = np.flatnonzero(self.pieces[j, :k] >= 0)
            np.add.at(out, self.pieces[j, use], weight * np.exp(a[j - 1 - use] + log[j, use] + b[j] - a[self.n]))


class LanguageModel:
    """Piece probabilities by language, and texts' scores under them."""

    def __init__(self, languages: list[str], vocab: dict[str, int], p: np.ndarray, usual: np.ndarray | None = None):
        self.languages, self.vocab, self.p = languages, vocab, p  # p: language x (piece, ..., 0)
        self.usual = np.tile(  # log probability a letter of a language's words: mean, deviation
            [0.0, np.inf],
            (len(languages), 1),
        ) if usual is None else usual
        self.number: dict[str, int] = {}
        self.rows, self.fits = np.zeros((0, len(languages) + 1)), np.zeros((0, len(languages)), np.int32)

    @classmethod
    def fitted(cls, languages: list[str], words: list[str], counts: np.ndarray, vocab: dict[str, int]) -> LanguageModel:
        """languages and words: in order; counts: of each language's runs of letters, a column a word."""
        size = len(vocab) + 2
        short = [i for i, w in enumerate(words) if len(w) < LONG]
        long_ = [(i, LongWord(MARK + w, vocab)) for i, w in enumerate(words) if len(w) >= LONG]
        groups = [(np.array([short[i] for i in at]), Lattices([MARK + w for w in ws], vocab)) for at, ws in _by_length([words[i] for i in short])]
        p, flat, total = np.zeros((len(languages), size)), np.zeros(size), counts.sum(0)
        for at, lattice in groups:  # at first: how often a piece could be used
            for k in lattice.used:
                np.add.at(flat, lattice.pieces[:, k], total[at])
        for i, lattice in long_:
            np.add.at(flat, lattice.pieces[lattice.pieces >= 0], total[i])
        flat[0] = flat[-1] = 0
        p[:] = (flat + 0.1) / (flat + 0.1).sum()
        for _ in range(ROUNDS):
            p[:, 0], p[:, -1] = UNKNOWN, 0
            used = np.zeros_like(p)
            for x, own in enumerate(used):
                for at, lattice in groups:
                    w = counts[x, at]
                    some = np.flatnonzero(w)
                    if len(some):
                        part = Lattices.__new__(Lattices)
                        part.n, part.spans, part.pieces = lattice.n, lattice.spans, lattice.pieces[some]
                        part.used = np.flatnonzero((part.pieces >= 0).any(0))
                        part.expected(p[x], w[some], own)
                for i, lattice in long_:
                    if counts[x, i]:
                        lattice.expected(p[x], counts[x, i], own)
            used[:, 0] = used[:, -1] = 0
            shared = used.sum(0) / max(1.0, used.sum())
            p = (used + 5 * shared + 1e-3) / (used + 5 * shared + 1e-3).sum(1, keepdims=True)
        p[:, 0], p[:, -1] = UNKNOWN, 0
        del groups, long_
        model = cls(languages, vocab, p)
        for x in range(len(languages)):
            some = np.flatnonzero(counts[x])
            own = [words[i] for i in some]
            size_ = np.array([len(w) for w in own], float)
            letters, each = counts[x, some] * size_, model.word_scores(own, x)[:, 0] / size_
            mean = (letters * each).sum() / letters.sum()
            if letters.sum() >= ENOUGH:  # else nothing is unusual
                model.usual[x] = mean, max(LEAST_FAR / FAR, np.sqrt((letters * (each - mean) ** 2).sum() / letters.sum()))
        return model

    def word_scores(self, words: list[str], only: int | None = None) -> np.ndarray:
        """log probability of runs of letters, a column a language (or only one's)."""
        wanted = range(len(self.languages)) if only is None else [only]
        out = np.zeros((len(words), len(wanted)))
        for at, ws in _by_length(words):
            if len(ws[0]) < LONG:
                lattice = Lattices([MARK + w for w in ws], self.vocab)
                for column, x in enumerate(wanted):
                    out[at, column] = np.log(lattice.forward(self.p[x])[:, -1]) - lattice.n * np.log(RAISE)
            else:
                for i, w in zip(at, ws):
                    out[i] = self._long(MARK + w)[list(wanted)]
        return out

    def _long(self, word: str) -> np.ndarray:
        """The forward algorithm over one long word, scaled at each step."""
        window, log = [np.ones(len(self.languages))], np.zeros(len(self.languages))
        get = self.vocab.get
        for j in range(1, len(word) + 1):
            total = np.zeros(len(self.languages))
            for back, a in enumerate(reversed(window), 1):
                if (k := get(word[j - back : j], 0 if back == 1 else -1)) >= 0:
                    total += a * self.p[:, k]
            log += np.log(total)
            window = [a / total for a in window[-LONGEST + 1 :]] + [np.ones(len(self.languages))]
        return log

    def _known(self, distinct: list[str]) -> np.ndarray:
        """Row numbers of words; a row is log probabilities and the number of runs, and of fits the number of runs as likely as in each language."""
        if len(self.number) + len(distinct) > CACHED:
            self.number.clear()
        new = [w for w in distinct if w not in self.number]
        if new:
            own = [runs(w) for w in new]
            flat = [r for rs in own for r in rs]
            single = sorted(set(flat))
            where = dict(zip(single, range(len(single))))
            scores = self.word_scores(single)
            fit = (scores / np.maximum([[len(r)] for r in single] or 1, 1) >= self.usual[:, 0] - FAR * self.usual[:, 1]).astype(np.int32)
            rows, fits = np.zeros((len(new), len(self.languages) + 1)), np.zeros((len(new), len(self.languages)), np.int32)
            of, at = np.repeat(np.arange(len(new)), [len(rs) for rs in own]), [where[r] for r in flat]
            np.add.at(rows, of, np.column_stack([scores[at], np.ones(len(flat))]) if flat else np.zeros((0, rows.shape[1])))
            np.add.at(fits, of, fit[at] if flat else np.zeros((0, fits.shape[1]), np.int32))
            n = len(self.number)
            self.rows, self.fits = np.concatenate([self.rows[:n], rows]), np.concatenate([self.fits[:n], fits])
            self.number.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))

    def text_scores(self, text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, whether half of the words or more are as likely as that language's usually are) of each text.

        The score compares the learnt languages only; how likely words are does not, so it tells texts that are in none
        of them.  A word is unusual if its log probability a letter is FAR deviations, and LEAST_FAR, below the
        language's mean; texts of fewer than JUDGED words, of which a key or a name is a large part, are usual, and so
        are all texts in a language learnt from fewer than ENOUGH letters.
        """
        start, code, distinct = coded(pc.split_pattern(pc.replace_substring(text, "\n", " "), " "))
        rows = self._known(distinct)[code]
        total = np.add.reduceat(self.rows[rows], start[:-1], axis=0) if len(rows) else np.zeros((len(text), len(self.languages) + 1))
        fits = np.add.reduceat(self.fits[rows], start[:-1], axis=0) if len(rows) else np.zeros((len(text), len(self.languages)))
        logs, n = total[:, :-1], total[:, -1]
        best = logs.argmax(1)
        score = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        usual = (n > 0) & ((n < JUDGED) | (fits[np.arange(len(best)), best] >= n / 2))
        return [self.languages[b] if k else "und" for b, k in zip(best, n)], np.where(n > 0, score, 0.0), usual


def _run_counts(batches):
    kind = pa.schema([("lang", pa.string()), ("run", pa.string()), ("n", pa.int64())])
    for batch in batches:
        for rows, text in text_slices(batch):
            counts: dict[tuple[str, str], int] = defaultdict(int)
            start, code, distinct = coded(pc.split_pattern(pc.replace_substring(text, "\n", " "), " "))
            own = [runs(w) for w in distinct]
            langs = np.array(rows.column(rows.schema.get_field_index("lang")).to_pylist(), object)
            for lang in set(langs.tolist()):
                mine = np.repeat(langs == lang, np.diff(start))
                for k, n in enumerate(np.bincount(code[mine], minlength=len(distinct)).tolist()):
                    if n:
                        for r in own[k]:
                            counts[lang, r] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(
                    zip(*((*k, n) for k, n in counts.items())),
                    kind,
                )] if counts else [pa.array([], f.type) for f in kind],
                schema=kind,
            )


def fitted(docs: DataFrame, learn: DataFrame, path: str, bound: int = SAMPLE_DOCS) -> LanguageModel | None:
    """The model of labelled documents; None without any.  learn: doc_id, lang of those that may be learnt from."""
    sample = sampled(learn, "lang", bound)
    own = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = arrow_map(
        own.select("lang", "text"),
        _run_counts,
        "lang string, run string, n long",
    ).groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    lang, run = (found.column(c).combine_chunks().dictionary_encode() for c in ("lang", "run"))
    languages, words = lang.dictionary.to_pylist(), run.dictionary.to_pylist()
    by_name, by_word = (np.argsort(np.argsort(np.array(x, object))) for x in (languages, words))  # places in order, whatever order rows came in
    counts = np.zeros((len(languages), len(words)), np.float32)
    counts[by_name[lang.indices.to_numpy()], by_word[run.indices.to_numpy()]] = found.column("n").to_numpy()
    del found, lang, run
    model = LanguageModel.fitted(sorted(languages), sorted(words), counts, vocabulary(path))
    del counts, words
    settled(docs.sparkSession)
    return model


def _predicting(spark: SparkSession, model: LanguageModel):
    """A function that runs on executors: languages and scores of the rows of a batch, slice by slice."""
    shared, name = spark.sparkContext.broadcast((  # as large as the vocabulary times the languages
        model.languages,
        model.vocab,
        model.p,
        model.usual,
    )), uuid.uuid4().hex

    def predictions(batch):
        own = held(("languages", name), lambda: LanguageModel(*shared.value))
        for part, text in text_slices(batch):
            yield part, *own.text_scores(text)

    return predictions


def predicted(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score of each document."""
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).cast("double").alias("score"))
    predictions = _predicting(docs.sparkSession, model)

    def rows(batches):
        for batch in batches:
            for part, langs, scores, _ in predictions(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return arrow_map(docs.select("doc_id", "text"), rows, "doc_id long, lang_pred string, score double")


def selected(docs: DataFrame, model: LanguageModel | None, least: float) -> DataFrame:
    """The documents, with all their columns, that are in a learnt language: words as likely as there, and a score of `least` or more."""
    if model is None:
        return docs
    predictions = _predicting(docs.sparkSession, model)

    def rows(batches):
        for batch in batches:
            for part, langs, scores, usual in predictions(batch):
                yield part.filter(pa.array([x != "und" and s >= least and bool(u) for x, s, u in zip(langs, scores, usual)], pa.bool_()))

    return arrow_map(docs, rows, docs.schema)


def identified(docs: DataFrame, path: str, bound: int = SAMPLE_DOCS, folds: int = 5) -> DataFrame:
    """Fits on the documents outside the held-out fold and predicts all."""
    out = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(True))
    model = fitted(docs, docs.filter(~out).select("doc_id", "lang"), path, bound)
    return predicted(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out fold."""
    return identified(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
