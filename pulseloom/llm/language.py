"""Language identification by unigrams over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word is the sum over all its segmentations into pieces, found by the forward algorithm, and a
text is a sequence of words. The language with the largest posterior is predicted.

Piece probabilities come from expected counts: one forward-backward pass over the training words
with all pieces equally likely, then smoothing towards the counts of all languages together.

The fit reads at most about ``fit_rows`` labelled rows, drawn evenly by a hash. The model has
pieces x languages numbers, so it fits a broadcast whatever the corpus.

Defined results
---------------
* A NULL text, or one without a letter, is ``und`` with score 0.
* Without any labelled text nothing can be learnt: every text is ``und`` with score 0.
* Letters and marks outside the vocabulary share one piece for the unknown.
* Rows that repeat a document are predicted each.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Labelled rows to fit on at most, about.
FIT_ROWS = 20_000
#: Words kept per worker, beyond which those met in one batch only are forgotten; words whose
#: lattices are held at a time.
KEPT_WORDS = 800_000
LATTICE_WORDS = 20_000
#: Longer words are worked on one at a time.
LONG_WORD = 64
_SMOOTHING = 2_000.0
_MARK = "▁"
_LETTER = regex.compile(r"\p{L}")


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[str, int], int]:
    """Piece numbers by text, -1 for texts that only begin a piece; and how many, the unknown included."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    numbers: dict[str, int] = {}
    for piece in kept:
        for end in range(1, len(piece)):
            numbers.setdefault(piece[:end], -1)
    for n, piece in enumerate(kept):
        numbers[piece] = n
    return numbers, len(kept) + 1


class Lattice:
    """All ways to cut some words into pieces: edges sorted by their end."""

    def __init__(self, words: list[str], numbers: dict[str, int], unknown: int) -> None:
        # An edge is one number: word, start, end and piece in a mixed base.
        edges: list[int] = []
        append, get = edges.append, numbers.get
        span, count = max(map(len, words), default=0) + 2, unknown + 1
        for w, text in enumerate(words):
            text = _MARK + text
            size = len(text)
            for i in range(size):
                base = (w * span + i) * span
                end, n = i + 1, get(text[i])
                # A letter that is no piece of its own is the unknown one.
                append((base + end) * count + (unknown if n is None or n < 0 else n))
                while n is not None and end < size:
                    end += 1
                    n = get(text[i:end])
                    if n is not None and n >= 0:
                        append((base + end) * count + n)
        self.words = len(words)
        self.sizes = np.array([len(w) + 1 for w in words])
        places, self.piece = np.divmod(np.array(edges, np.int64), count)
        places, self.end = np.divmod(places, span)
        self.word, self.start = np.divmod(places, span)
        order = np.argsort(self.end, kind="stable")
        self.word, self.start, self.end, self.piece = (x[order] for x in (self.word, self.start, self.end, self.piece))

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """(words, positions, languages): log of the summed probability up to each position."""
        sums = np.full((self.words, int(self.sizes.max()) + 1, log_p.shape[1]), -np.inf)
        sums[:, 0] = 0
        bounds = np.searchsorted(self.end, np.arange(1, sums.shape[1] + 1))
        for j in range(1, sums.shape[1]):
            low, high = bounds[j - 1], bounds[j]
            if low == high:
                continue
            w = self.word[low:high]
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            reached = sums[w, self.start[low:high]] + log_p[self.piece[low:high]]
            sums[w[first], j] = np.logaddexp.reduceat(reached, first)
        return sums

    def totals(self, log_p: np.ndarray) -> np.ndarray:
        """(words, languages): log probability of each word over all its segmentations."""
        return self.forward(log_p)[np.arange(self.words), self.sizes]

    def expected(self, log_p: np.ndarray) -> np.ndarray:
        """Per edge, the chance that a segmentation takes it, for one language."""
        ahead = self.forward(log_p)[:, :, 0]
        back = np.full(ahead.shape, -np.inf)
        back[np.arange(self.words), self.sizes] = 0
        order = np.lexsort((self.word, -self.start))
        starts = -self.start[order]
        bounds = np.searchsorted(starts, -np.arange(ahead.shape[1]), side="right")
        low = 0
        for position in range(ahead.shape[1] - 1, -1, -1):
            high = bounds[position]
            edges = order[low:high]
            low = high
            if not len(edges):
                continue
            w = self.word[edges]
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            reached = back[w, self.end[edges]] + log_p[self.piece[edges], 0]
            back[w[first], position] = np.logaddexp.reduceat(reached, first)
        whole = ahead[np.arange(self.words), self.sizes]
        return np.exp(ahead[self.word, self.start] + log_p[self.piece, 0] + back[self.word, self.end] - whole[self.word])


def _lattices(words: list[str], numbers: dict[str, int], unknown: int) -> Iterator[tuple[list[str], Lattice]]:
    short = [w for w in words if len(w) <= LONG_WORD]
    groups = [short[i : i + LATTICE_WORDS] for i in range(0, len(short), LATTICE_WORDS)]
    for group in groups + [[w] for w in words if len(w) > LONG_WORD]:
        yield group, Lattice(group, numbers, unknown)


@dataclass(frozen=True)
class LanguageModel:
    """log_p[piece, language], log priors and the languages' names."""

    languages: list[str]
    log_p: np.ndarray
    log_prior: np.ndarray
    vocabulary: str

    @property
    def name(self) -> str:
        """Tells models apart by what they hold."""
        parts = (repr(self.languages).encode(), self.vocabulary.encode(), self.log_p.tobytes(), self.log_prior.tobytes())
        return hashlib.blake2b(b"|".join(parts)).hexdigest()


def piece_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """lang, piece, expected: expected counts of pieces over the words of labelled texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, size = pieces(vocabulary)
        equal = np.full((size, 1), -math.log(size))
        sums: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def flush() -> None:
            for lang, counts in words.items():
                total = sums.setdefault(lang, np.zeros(size))
                for group, lattice in _lattices(list(counts), numbers, size - 1):
                    times = np.array([counts[w] for w in group], float)
                    total += np.bincount(lattice.piece, lattice.expected(equal) * times[lattice.word], minlength=size)
            words.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, words.values())) > KEPT_WORDS:
                flush()
        flush()
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], ["lang", "piece", "expected"]
            )

    counted = docs.select("text", "lang").mapInArrow(count, "lang string, piece long, expected double")
    return counted.groupBy("lang", "piece").agg(F.sum("expected").alias("expected"))


def fit(docs: DataFrame, vocabulary: str, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from rows with text and lang; about ``fit_rows`` of them, drawn evenly by a hash of the text."""
    labelled = docs.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    total = sum(sizes.values())
    if total > fit_rows:
        share = int(fit_rows / total * 1_000_000)
        labelled = labelled.where(F.pmod(F.xxhash64("text", F.lit("fit")), F.lit(1_000_000)) < share)
    languages = sorted(sizes)
    _, size = pieces(vocabulary)
    counts = np.zeros((size, len(languages)))
    if languages:
        # At most pieces x languages rows.
        found = piece_counts(labelled, vocabulary).toPandas()
        places = {lang: i for i, lang in enumerate(languages)}
        np.add.at(counts, (found["piece"].to_numpy(int), found["lang"].map(places).to_numpy(int)), found["expected"].to_numpy(float))
    overall = counts.sum(axis=1, keepdims=True) + 0.01
    smoothed = counts + _SMOOTHING * overall / overall.sum()
    log_p = np.log(smoothed / smoothed.sum(axis=0, keepdims=True)) if languages else smoothed
    prior = np.log([(sizes[lang] + 1) / (total + len(languages)) for lang in languages])
    return LanguageModel(languages, log_p, prior, vocabulary)


class WordScores:
    """Log probabilities of words per language, with a bounded memory that changes no result."""

    _last: tuple[str, WordScores] | None = None

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.numbers, self.size = pieces(model.vocabulary)
        self.places: dict[str, int] = {}
        self.again: set[str] = set()
        self.rows = np.empty((1024, len(model.languages)))

    @classmethod
    def shared(cls, model: LanguageModel) -> WordScores:
        """What the worker process remembers of the model that it used last."""
        if cls._last is None or cls._last[0] != model.name:
            cls._last = (model.name, cls(model))
        return cls._last[1]

    def _keep(self, words: list[str]) -> None:
        rows = self.rows[[self.places[w] for w in words]]
        self.places = {w: n for n, w in enumerate(words)}
        self.rows[: len(words)] = rows

    def _add(self, words: list[str], totals: np.ndarray) -> None:
        n = len(self.places)
        if n + len(words) > len(self.rows):
            grown = np.empty((2 * (n + len(words)), self.rows.shape[1]))
            grown[:n] = self.rows[:n]
            self.rows = grown
        self.rows[n : n + len(words)] = totals
        self.places.update(zip(words, range(n, n + len(words)), strict=True))

    def batch(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Per text, the sum over its words."""
        wanted = set().union(*texts)
        new = wanted.difference(self.places)
        if len(self.places) + len(new) > KEPT_WORDS:
            known = wanted - new
            self._keep(list(known | self.again if len(self.again) < KEPT_WORDS // 2 else known))
            self.again = set()
            new = wanted.difference(self.places)
        self.again |= wanted - new
        for group, lattice in _lattices(list(new), self.numbers, self.size - 1):
            self._add(group, lattice.totals(self.model.log_p))
        return [self.rows[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(axis=0) for words in texts]


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score per row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores.shared(model) if model.languages else None
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = [t if t and scores and _LETTER.search(t) else "" for t in part.column("text").to_pylist()]
                langs, chances = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                read = [i for i, t in enumerate(texts) if t]
                sums = scores.batch([texts[i].split() for i in read]) if read else []
                for i, total in zip(read, sums, strict=True):
                    total = total + model.log_prior
                    best = int(total.argmax())
                    langs[i], chances[i] = model.languages[best], float(1 / np.exp(total - total[best]).sum())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs), pa.array(chances)], ["doc_id", "lang_pred", "score"]
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(score, "doc_id long, lang_pred string, score double")
