"""Importance resampling against plain Python over strings."""

import hashlib
import math
import random
import re
import zlib

import pytest

from pulseloom.llm import importance
from pulseloom.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    """Words and features of a text."""
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(folded)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, least=20, buckets=10_000, seed=42):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in runs(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    total, wanted = float(sum(s) + buckets), float(sum(t) + buckets)
    gain = [math.floor(1000 * math.log((y + 1) * total / ((x + 1) * wanted))) for x, y in zip(s, t, strict=True)]
    rows = []
    for doc, text in docs:
        words, features = runs(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(features), weight, score, len(words)))
    ranked = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    place = {id(r): n + 1 for n, r in enumerate(ranked[: percent * len(ranked) // 100])}
    return [(*r[:4], place.get(id(r))) for r in rows]


def drawn(docs, target, **settings):
    df, name = importance.resample(docs, target, keep=["doc_id"], **settings)
    return [tuple(r) for r in df.select("doc_id", *[name(c) for c in ("n_features", "weight", "score", "rank")]).collect()]


def same(a, b):
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    return sorted(a, key=key) == sorted(b, key=key)


@pytest.mark.parametrize("block", [1, 9, 64, 2 << 20])
def test_features_of_a_batch(block, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", block)
    pick = random.Random(block)
    letters = ["a", "B", "Zz", "é", "ÀÉ", "語", "1", " ", "\0", "-", "\n", "x" * 70, "  ", "'"]
    for _ in range(60):
        texts = ["".join(pick.choices(letters, k=pick.randint(0, 30))) for _ in range(pick.randint(0, 5))]
        words, found = [0] * len(texts), [[] for _ in texts]
        for new, doc, bucket in importance.features([t.encode() for t in texts], 10_000):
            for d in new.tolist():
                words[d] += 1
            for d, b in zip(doc.tolist(), bucket.tolist(), strict=True):
                found[d].append(b)
        for text, n, buckets in zip(texts, words, found, strict=True):
            plain, features = runs(text)
            assert n == len(plain)
            assert sorted(buckets) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features)


def test_checksums_of_long_words():
    import numpy as np

    for length in (0, 1, 63, 64, 65, 1000, 100_003):
        got = importance.shifted(np.array([zlib.crc32(b"left")], np.uint32), np.array([length])) ^ np.uint32(zlib.crc32(b"r" * length))
        assert got[0] == zlib.crc32(b"left" + b"r" * length)


def test_matches_brute_force(docs_of, spark):
    pick = random.Random(6)
    vocabulary = [f"w{n}" for n in range(300)] + ["Été", "語", "x" * 90]
    docs = [(d, " ".join(pick.choices(vocabulary, k=pick.choice([0, 3, 19, 20, 60])))) for d in range(300)]
    # Equal texts and ids tie; a NULL id, a NULL text, and a very long text.
    docs += [(d, docs[4][1]) for d in (3, 3, 500)] + [(None, docs[5][1]), (600, None), (601, "--"), (602, " ".join(pick.choices(vocabulary, k=30_000)))]
    target = [" ".join(pick.choices(vocabulary[:30], k=40)) for _ in range(20)] + [None, ""]
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    for settings in ({}, {"percent": 50, "least_words": 3, "seed": 7, "buckets": 97}):
        names = {"percent": "percent", "least_words": "least", "seed": "seed", "buckets": "buckets"}
        assert same(drawn(docs_of(docs), benchmark, **settings), brute(docs, target, **{names[k]: v for k, v in settings.items()}))


def test_empty_tables_and_clashing_names(docs_of, spark):
    empty = spark.createDataFrame([], "text string")
    assert drawn(docs_of([]), empty) == []
    docs = docs_of([(1, "a b c"), (2, None)], rank=5, Score="s", weight=1.5, _text=3, _salt=4)
    df, name = importance.resample(docs, empty, percent=100, least_words=1)
    rows = sorted(df.collect(), key=lambda r: r["doc_id"])
    assert [name(c) for c in ("rank", "score", "weight", "n_features")] == ["rank_", "score_", "weight_", "n_features"]
    assert [(r["rank"], r["Score"], r["weight"], r["_text"], r["_salt"], r["text"]) for r in rows] == [(5, "s", 1.5, 3, 4, "a b c"), (5, "s", 1.5, 3, 4, None)]
    assert [(r["n_features"], r["rank_"]) for r in rows] == [(6, 1), (0, None)]


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect()]
    found = QUERIES["op11_batched_importance"](spark, SF_DIR)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    expected = brute(docs, target)
    assert same([tuple(r) for r in found.collect()], expected)
    assert any(r[4] for r in expected)
