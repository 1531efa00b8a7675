"""Toxicity scores by weak supervision.

1. Lexicon: all word beginnings that stand out in toxic texts of a bounded sample of labelled rows.
   A text counts once, however many copies of it are labelled.
2. Voters: groups of these stems, and patterns (shouting, bursts of marks, masked words, many
   hits). Each votes for toxic or abstains.
3. Label model: a generative model of the votes given the class, with each voter's accuracy and
   its correlations. The correlations are a tree over the voters (the one with the largest
   conditional mutual information), so a voter that repeats another adds nothing. It is fitted by
   expectation maximisation on the counts of vote patterns over all rows; labelled rows keep
   their class.
4. Linear classifier: logistic regression on the posteriors, over the strength of the two strongest
   stems of a text, and patterns. A stem's strength is its log odds between toxic and clean texts. One
   insult that clean texts never hold is so told from a word that they hold now and then, while
   any number of further hits adds nothing. The intercept is set so that 0.5 is the best cut (by F1)
   of the labelled rows drawn.

The counts of step 3 cover all rows given. The bounds are those of the model and of the samples:
``FIT_ROWS`` labelled rows for the lexicon and as many rows for the classifier, drawn evenly by a
hash, and at most 2^16 patterns of 16 voters. Stems have no bound of their own: each is in so many
toxic texts of the sample that few can be.

Defined results
---------------
* A NULL text is an empty one; it is scored like any text without hits.
* A document with several labels is toxic if one of them is 1. Other values than 0 and 1, and
  NULL ids, label nothing.
* Without labels the stems are those of ``SEED_STEMS`` and the label model learns from
  agreement alone.
* Rows that repeat a document are scored each.
* Texts that differ in white space only are one text to the lexicon, toxic if half of its labelled
  rows are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.session import materialise

#: Bounds of the samples and of the model.
FIT_ROWS = 20_000
LEXICON_VOTERS = 12
#: Lengths of a word's beginning that can become a stem.
STEM_CHARS = range(4, 9)
#: A stem is this many times as frequent among toxic texts, and in so many or this share of them.
LEAST_ODDS, LEAST_TEXTS, LEAST_SHARE = 20, 3, 0.005
#: Clean texts added to those of a stem, so that a rare one is not taken for a sure one; the strength of a seed.
DOUBT, SEED_STRENGTH = 2.5, 5.0
#: Stems to start from where nothing is labelled.
SEED_STEMS = ["idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "scum"]

SHOUT = re.compile(r"\b[A-Z]{4,}\b[^a-z]{1,3}\b[A-Z]{4,}\b")
MASKED = re.compile(r"[A-Za-z][*#@$]{2,}")
PATTERNS = ["shout", "burst", "masked", "many"]


def words_of(text: str) -> set[str]:
    """Distinct lower-case words, without marks in front."""
    return {w if w[0].isalpha() else w.lstrip("\"'([{<*-_.,;:!?¿¡«“”„") for w in text.lower().split()}


def stem_counts(labelled: DataFrame) -> DataFrame:
    """stem, toxic, clean: texts of each class that have a word with that beginning."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                found = words_of(text or "")
                counts[toxic].update({w[:n] for w in found for n in STEM_CHARS if len(w) >= n})
        stems = list(counts[0] | counts[1])
        columns = [pa.array(stems, pa.string()), *[pa.array([counts[c][s] for s in stems], pa.int64()) for c in (1, 0)]]
        yield pa.RecordBatch.from_arrays(columns, ["stem", "toxic", "clean"])

    found = labelled.select("text", "toxic").mapInArrow(count, "stem string, toxic long, clean long")
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(counts: list[tuple[str, int, int]]) -> list[str]:
    """The stems by strength, none of which begins another; of equal ones the longest."""
    chosen: list[str] = []
    begun: set[str] = set()
    ended: set[str] = set()
    for stem, _, _ in sorted(counts, key=lambda c: (-c[1], -len(c[0]), c[0])):
        starts = {stem[:n] for n in range(1, len(stem) + 1)}
        if stem not in begun and not starts & ended:
            chosen.append(stem)
            begun |= starts
            ended.add(stem)
    return chosen


class Reader:
    """Finds stems and patterns in texts."""

    def __init__(self, stems: list[str]) -> None:
        self.stems = stems
        self.finder = ahocorasick.Automaton()
        for n, stem in enumerate(stems):
            self.finder.add_word(stem, (n, len(stem)))
        if stems:
            self.finder.make_automaton()

    def counts(self, text: str) -> Counter[int]:
        """Hits per stem, at the beginning of words only."""
        found: Counter[int] = Counter()
        if self.stems:
            lower = text.lower()
            for end, (n, size) in self.finder.iter(lower):
                start = end - size + 1
                if start == 0 or not lower[start - 1].isalpha():
                    found[n] += 1
        return found

    def read(self, text: str) -> tuple[int, Counter[int]]:
        """The votes as bits, and the hits per stem."""
        hits = self.counts(text)
        patterns = [bool(SHOUT.search(text)), "!!" in text or "?!" in text, bool(MASKED.search(text)), len(hits) >= 3]
        votes = 0
        for n in hits:
            # Stems come by strength, so a voter's stems are about equally sure.
            votes |= 1 << (n * LEXICON_VOTERS // len(self.stems))
        for n, on in enumerate(patterns):
            votes |= on << (LEXICON_VOTERS + n)
        return votes, hits


VOTERS = LEXICON_VOTERS + len(PATTERNS)


def votes_and_hits(docs: DataFrame, stems: list[str]) -> DataFrame:
    """doc_id, votes, and the two first, so strongest, stems found per row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(stems)
        for batch in batches:
            found = [reader.read(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([v for v, _ in found], pa.int32())]
            columns.append(pa.array([sorted(h)[:2] for _, h in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "votes", "stems"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(read, "doc_id long, votes int, stems array<int>")


def features(votes: list[int], stems: list[list[int]], strengths: np.ndarray) -> np.ndarray:
    """Strength of the strongest and the second stem, 0 where there is none, and the patterns but the count of hits."""
    x = np.zeros((len(votes), 2 + len(PATTERNS) - 1))
    for row, found in enumerate(stems):
        for place, n in enumerate(found[:2]):
            x[row, place] = strengths[n]
    x[:, 2:] = (np.array(votes, int).reshape(-1, 1) >> (LEXICON_VOTERS + np.arange(len(PATTERNS) - 1))) & 1
    return x


@dataclass(frozen=True)
class LabelModel:
    """P(toxic), and per voter its parent and P(vote | parent's vote, class)."""

    prior: float
    parents: list[int]
    chances: np.ndarray  # [voter, class, parent's vote]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes) for rows of 0/1 votes."""
        logs = np.log([1 - self.prior, self.prior]) + np.zeros((len(votes), 2))
        for v, parent in enumerate(self.parents):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            for c in (0, 1):
                p = self.chances[v, c, given]
                logs[:, c] += np.log(np.where(votes[:, v] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def _tree(votes: np.ndarray, by_class: list[np.ndarray]) -> list[int]:
    """Parents in the spanning tree of largest mutual information given the class."""
    n = votes.shape[1]
    information = np.zeros((n, n))
    for weight in by_class:
        total = weight.sum() + 4
        for x in (0, 1):
            for y in (0, 1):
                joint = ((votes == x) * weight[:, None]).T @ (votes == y) + 1
                px = (joint + (((votes == x) * weight[:, None]).T @ (votes != y) + 1)) / total
                py = (joint + (((votes != x) * weight[:, None]).T @ (votes == y) + 1)) / total
                information += joint * np.log(joint / total / (px * py))
    parents, inside = [-1] * n, {0}
    while len(inside) < n:
        _, a, b = max((information[a, b], a, b) for a in inside for b in range(n) if b not in inside)
        parents[b] = a
        inside.add(b)
    return parents


def fit_label_model(patterns: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation maximisation on counted vote patterns; label -1 is unknown."""
    votes = (patterns[:, None] >> np.arange(VOTERS)) & 1
    # Voters speak for toxic, so the first guess follows how many of them do.
    toxic = np.where(labels >= 0, labels, np.clip(votes.sum(axis=1) / 3, 0.02, 0.98)).astype(float)
    model = LabelModel(0.5, [-1] * VOTERS, np.full((VOTERS, 2, 2), 0.5))
    for _ in range(rounds):
        by_class = [counts * (1 - toxic), counts * toxic]
        parents = _tree(votes, by_class)
        chances = np.empty((VOTERS, 2, 2))
        for v, parent in enumerate(parents):
            for c, weight in enumerate(by_class):
                for given in (0, 1):
                    at = weight * ((votes[:, parent] == given) if parent >= 0 else 1)
                    # Half a vote against: a voter that never spoke is taken as one that abstains.
                    chances[v, c, given] = ((at * votes[:, v]).sum() + 0.05) / (at.sum() + 1)
        prior = (by_class[1].sum() + 1) / (counts.sum() + 2)
        model = LabelModel(float(prior), parents, chances)
        before, toxic = toxic, np.where(labels >= 0, labels, model.posterior(votes))
        if np.abs(before - toxic).max(initial=0) < 1e-6:
            break
    return model


def fit_linear(features: np.ndarray, targets: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Weights and intercept of a logistic regression on soft targets, by Newton's method."""
    x = np.c_[features, np.ones(len(features))]
    ridge = np.array([penalty] * (x.shape[1] - 1) + [1e-3])
    weights = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - targets * z).sum() + w @ (ridge * w) / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (p - targets) + ridge * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        size = 1.0
        while size > 1e-4 and loss(weights - size * step) > loss(weights):
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return weights


def best_level(sums: np.ndarray, labels: np.ndarray) -> float:
    """Where to cut the sums so that the labelled rows above hold the best F1: the middle of the gap, 0 without both classes."""
    if not (labels == 1).any() or (labels == 1).all():
        return 0.0
    order = np.argsort(-sums, kind="stable")
    ordered, hits = sums[order], np.cumsum(labels[order] == 1)
    # A cut lies between two different sums.
    ends = np.flatnonzero(ordered[1:] < ordered[:-1])
    if not len(ends):
        return 0.0
    f1 = 2 * hits[ends] / (ends + 1 + hits[-1])
    best = ends[np.argmax(f1)]
    return float(ordered[best] + ordered[best + 1]) / 2


@dataclass(frozen=True)
class ToxicityModel:
    stems: list[str]
    strengths: np.ndarray
    label_model: LabelModel
    weights: np.ndarray


def _drawn(key: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("toxicity")), F.lit(1_000_000)) < int(share * 1_000_000)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = materialise(known.agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # About fit_rows labels: a bounded side, so that texts need no shuffle.
    sample = known.where(_drawn(F.col("doc_id"), min(1.0, fit_rows / max(1, known.count()))))
    labelled = texts.join(F.broadcast(sample), "doc_id")
    plain = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]+", " ")
    distinct = labelled.groupBy(plain.alias("text")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    distinct = materialise(distinct, "toxic-texts")
    totals = {r["toxic"]: r["count"] for r in distinct.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    strong = (F.col("toxic") + 0.5) / (toxic + 1) >= LEAST_ODDS * (F.col("clean") + 0.5) / (clean + 1)
    frequent = F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic)
    # Each text has so many beginnings at most, so few are in that share of the toxic ones.
    counts = stem_counts(distinct).where(strong & frequent)
    counted = {r["stem"]: (r["toxic"], r["clean"]) for r in counts.collect()}
    odds = {s: np.log((a + 0.5) / (toxic + 1)) - np.log((b + DOUBT) / (clean + 1)) for s, (a, b) in counted.items()}
    chosen = choose_stems([(s, *n) for s, n in counted.items()])
    stems = sorted(chosen, key=lambda s: (-odds[s], s)) or SEED_STEMS
    strengths = np.array([odds[s] for s in stems]) if chosen else np.full(len(stems), SEED_STRENGTH)

    rows = materialise(votes_and_hits(texts, stems).join(known, "doc_id", "left"), "votes")
    rows = rows.withColumn("toxic", F.coalesce("toxic", F.lit(-1)))
    patterns = rows.groupBy("votes", "toxic").count().toPandas()  # 2^VOTERS x 3 at most
    model = fit_label_model(patterns["votes"].to_numpy(int), patterns["toxic"].to_numpy(int), patterns["count"].to_numpy(float))

    total = int(patterns["count"].sum())
    drawn = rows.where(_drawn(F.coalesce("doc_id", F.monotonically_increasing_id()), min(1.0, fit_rows / max(1, total))))
    drawn = drawn.select("votes", "toxic", "stems").toPandas()
    if not len(drawn):
        return ToxicityModel(stems, strengths, model, np.zeros(len(PATTERNS) + 2))
    votes = (drawn["votes"].to_numpy(int)[:, None] >> np.arange(VOTERS)) & 1
    given = drawn["toxic"].to_numpy(int)
    targets = np.where(given >= 0, given, model.posterior(votes))
    read = features(drawn["votes"].tolist(), drawn["stems"].tolist(), strengths)
    weights = fit_linear(read, targets)
    known_rows = given >= 0
    sums = read[known_rows] @ weights[:-1] + weights[-1]
    weights[-1] -= best_level(sums, given[known_rows])
    return ToxicityModel(stems, strengths, model, weights)


def score(model: ToxicityModel, text: Column) -> Column:
    """The chance that a text is toxic, 0 to 1."""

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.stems)
        for texts in batches:
            found = [reader.read(t or "") for t in texts]
            x = features([v for v, _ in found], [sorted(h)[:2] for _, h in found], model.strengths)
            sums = x @ model.weights[:-1] + model.weights[-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -40, 40))))

    return chance(F.coalesce(text.cast("string"), F.lit("")))
