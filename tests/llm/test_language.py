import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.llm import language
from pulseloom.llm.vocabulary import vocabulary_path

PATH = vocabulary_path("piece_bpe_32k.model")
SYLLABLES = {"en": ["th", "and", "er", "ing", "on"], "fr": ["que", "é", "eux", "ment", "oi"], "es": ["ción", "ado", "ll", "ña", "os"]}


def sentences(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(4, 30))]
        out.append((i, " ".join(words), lang))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def brute_total(word, numbers, unknown, p):
    """Sum over all segmentations, one by one."""
    text = "▁" + word

    def rest(i):
        if i == len(text):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(text) + 1):
            n = numbers.get(text[i:j], -1)
            if n >= 0:
                total += p[n] * rest(j)
        return total + (p[unknown] * rest(i + 1) if numbers.get(text[i], -1) < 0 else 0.0)

    return rest(0)


def test_forward_sums_all_segmentations():
    numbers, size = language.pieces(PATH)
    rng = np.random.default_rng(1)
    log_p = np.log(rng.random((size, 3)) + 1e-3)
    words = ["the", "thing", "a", "ménage", "x😀y", "ſ中", "12a", "erererer", "." * 5]
    totals = language.Lattice(words, numbers, size - 1).totals(log_p)
    for w, word in enumerate(words):
        for c in range(3):
            assert math.isclose(totals[w, c], math.log(brute_total(word, numbers, size - 1, np.exp(log_p[:, c]))), rel_tol=1e-9)


def test_expected_counts_are_derivatives():
    """The expected count of a piece is the slope of log P in its log probability."""
    numbers, size = language.pieces(PATH)
    words = ["thing", "ererer", "x😀"]
    log_p = np.log(np.random.default_rng(2).random((size, 1)) + 1e-3)
    lattice = language.Lattice(words, numbers, size - 1)
    expected = lattice.expected(log_p)
    for w in range(len(words)):
        own = lattice.word == w
        for piece in np.unique(lattice.piece[own]):
            moved = log_p.copy()
            moved[piece] += 1e-6
            slope = (lattice.totals(moved)[w, 0] - lattice.totals(log_p)[w, 0]) / 1e-6
            assert math.isclose(expected[own & (lattice.piece == piece)].sum(), slope, abs_tol=1e-4)


def test_long_words_do_not_underflow():
    numbers, size = language.pieces(PATH)
    total = language.Lattice(["thand" * 2000], numbers, size - 1).totals(np.full((size, 1), -10.0))
    assert np.isfinite(total).all() and total[0, 0] < -1000


def test_held_out_accuracy_and_edge_cases(spark):
    model = language.fit(table(spark, sentences(300, 1)), PATH)
    assert model.languages == ["en", "es", "fr"]
    fresh = sentences(200, 2)
    rows = [*fresh, (900, None, "en"), (901, "", None), (902, " 12 34 !", "fr"), (903, "x" * 30_000, None), (904, "the " * 30_000, None)]
    found = {r.doc_id: r for r in language.predict(table(spark, rows).withColumn("score", F.lit("mine")), model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in fresh) >= 196
    assert all((found[i].lang_pred, found[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert found[904].lang_pred == "en" and all(0 <= r.score <= 1 for r in found.values()) and len(found) == len(rows)


def test_forgetting_words_changes_nothing(spark, monkeypatch):
    model = language.fit(table(spark, sentences(100, 1)), PATH)
    texts = [t.split() for _, t, _ in sentences(60, 3)]
    want = language.WordScores(model).batch(texts)
    monkeypatch.setattr(language, "KEPT_WORDS", 20)
    small = language.WordScores(model)
    assert all(np.allclose(small.batch([t])[0], w) for t, w in zip(texts, want, strict=True))


@pytest.mark.parametrize("rows", [[], [(1, "text", None), (2, None, "en")]])
def test_nothing_to_learn_from(spark, rows):
    model = language.fit(table(spark, rows), PATH)
    assert [r.lang_pred for r in language.predict(table(spark, rows), model).collect()] == ["und"] * len(rows)


def test_the_sample_is_bounded_and_even(spark):
    model = language.fit(table(spark, sentences(400, 1)), PATH, fit_rows=100)
    found = {r.doc_id: r.lang_pred for r in language.predict(table(spark, sentences(100, 5)), model).collect()}
    assert sum(found[i] == lang for i, _, lang in sentences(100, 5)) >= 95
