"""Weights of terms without moving the pairs of documents and terms."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.operators import models, terms


def _expected(rows, least=3):
    found = {}
    for key, text in rows:
        words = [w for w in (text or "").lower().split() if len(w) > 1]
        found.setdefault(key, Counter()).update(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    frequency = Counter(t for c in found.values() for t in c)
    out = {}
    for key, counts in found.items():
        w = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + frequency[t])) + 1) for t, n in counts.items() if frequency[t] >= least}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out |= {(key, t): v / norm for t, v in w.items()}
    return out


def _rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[j] for j in rng.zipf(1.3, rng.integers(0, 40)) % 60)) for i in range(300)]
    # Two rows of one key, keys of NULL, no text, an empty one, and a long one.
    return rows + [(5, "w1 w1 w2 seldom"), (None, "w1 w3"), (None, "w3 w4"), (901, None), (902, ""), (903, "w7 w8 " * 20_000)]


def test_weights_equal_plain_python(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, body string")
    found = models.tfidf_features(df, "id", "body").collect()
    expected = _expected(rows)
    assert len(found) == len(expected) and found[0].asDict().keys() == {"id", "term", "tfidf"}
    assert all(r["tfidf"] == pytest.approx(expected[r["id"], r["term"]], abs=1e-12) for r in found)
    assert models.tfidf_features(df.limit(0), "id", "body").count() == 0
    assert models.tfidf_features(df.limit(2), "id", "body", 3).count() == 0


def test_pairs_are_not_shuffled(spark):
    """The pairs moved three times: as a table, to the terms, and back to their documents."""
    df = spark.createDataFrame(_rows(), "id long, body string")
    plan = models.tfidf_features(df, "id", "body")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "Window" not in plan


def test_a_clash_of_hashes_takes_another_seed(spark, monkeypatch):
    df, seeds, real = spark.createDataFrame(_rows(), "id long, body string"), [], terms._weights

    def clashing(df, key, text, least, seed):
        seeds.append(seed)
        if seed == 0:
            raise terms.HashClash
        return real(df, key, text, least, seed)

    monkeypatch.setattr(terms, "_weights", clashing)
    assert terms.weights(df, "id", "body", 3).count() == len(_expected(_rows())) and seeds == [0, 1]
    *_, clash = terms.summed(np.array([4, 2, 4], np.uint64), np.array([1, 1, 7], np.uint16), np.ones(3, np.int64))
    assert clash


def test_numbers_are_packed_and_unpacked():
    rng = np.random.default_rng(1)
    for values in (np.sort(rng.integers(0, 2**64, 999, np.uint64)), np.zeros(0, np.uint64), np.array([0, 2**64 - 1], np.uint64)):
        assert (terms.unpacked_sorted(terms.packed_sorted(values)) == values).all()
    assert list(terms.unpacked(terms.packed(np.array([1, 300, 70_000])))) == [1, 300, 70_000] and len(terms.packed(np.ones(9, np.int64))) == 10


def test_blocks_are_merged_before_they_wait_too_long(spark, monkeypatch):
    sent = list(terms._send(4)(iter([])))
    assert sent == []
    monkeypatch.setattr(terms, "_WAITING", 1)
    df = spark.createDataFrame(_rows(), "id long, body string")
    assert models.tfidf_features(df, "id", "body").agg(F.count("*")).first()[0] == len(_expected(_rows()))
