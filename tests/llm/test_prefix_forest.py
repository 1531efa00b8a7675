import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.llm import prefix_forest as forest

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, is_query, k=5):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(np.float32(x) for x in v):
            continue
        good.setdefault((i, tuple(np.float32(v).tolist())), np.float32(v).astype(float))
    entries = [(i, v) for (i, _), v in good.items()]
    ids = np.array([i for i, _ in entries])
    matrix = np.stack([v for _, v in entries])
    norms = np.linalg.norm(matrix, axis=1)
    out = {}
    for i, v in entries:
        if is_query(i):
            scores = matrix @ v / (norms * np.linalg.norm(v))
            order = [n for n in np.lexsort((ids, -np.round(scores, 12))) if ids[n] != i][:k]
            out[i] = [(int(ids[n]), float(scores[n])) for n in order]
    return out


def found_by(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, want):
    hits = sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


def test_recall_on_vectors_without_structure(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((6000, 64)))]
    want = brute(rows, lambda i: i % 50 == 0)
    assert recall(found_by(forest.nearest(table(spark, rows), F.col("id") % 50 == 0)), want) >= 0.9


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 300)
    monkeypatch.setattr(forest, "QUERY_BLOCK", 9)
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((2000, 32)))]
    want = brute(rows, lambda i: i % 50 == 0)
    found = found_by(forest.nearest(table(spark, rows), F.col("id") % 50 == 0))
    assert found.keys() == want.keys() and all(len(f) == 5 for f in found.values())
    assert recall(found, want) >= 0.9
    exact = {q: dict(w) for q, w in brute(rows, lambda i: i % 50 == 0, 1999).items()}
    for q, near in found.items():
        assert all(abs(exact[q][v] - s) < 1e-12 for v, s in near)


def test_copies_ties_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(forest, "EFFORT", 1e9)  # the ascent reaches the roots: exact
    rng = np.random.default_rng(3)
    base = rng.integers(-3, 4, (30, 4)).astype(float)
    rows = [(i, base[i % 30] * (1 + i % 2)) for i in range(200)] + [(i, base[0]) for i in range(200, 400)]
    rows += [(1000, None), (1050, [0, 0, 0, 0]), (1100, [1, None, 2, 3]), (1150, [1, float("nan"), 2, 3]), (1200, [1, float("inf"), 2, 3])]
    rows += [(None, base[1]), (250, base[0]), (250, base[0]), (1250, [1.0, 2.0])]
    want = brute([r for r in rows if r[0] != 1250], lambda i: i % 50 == 0)
    found = found_by(forest.nearest(table(spark, rows), F.col("id") % 50 == 0))
    assert found.keys() == want.keys()
    for q in want:
        assert [round(s, 9) for _, s in found[q]] == [round(s, 9) for _, s in want[q]]
        # Scores of parallel vectors may differ in the last digit, so ids are compared within exact copies.
        copies = [v for v, s in want[q] if s > 1 - 1e-12]
        assert {v for v, s in found[q] if s > 1 - 1e-12} == set(copies) or q < 200


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0])]])
def test_few_rows(spark, rows):
    found = forest.nearest(table(spark, rows), F.col("id") % 50 == 0).collect()
    assert len(found) == max(0, len(rows) - 1)


def test_ascent_ends_at_whole_levels():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 2**forest.BITS, (3, 500), dtype=np.uint64), axis=1)
    asked = rng.integers(0, 2**forest.BITS, (3, 20), dtype=np.uint64)
    low, high = forest._ranges(keys, asked, 60)
    for q in range(20):
        lengths = [
            max(n for n in range(forest.BITS + 1) if int(k) >> (forest.BITS - n) == int(asked[t, q]) >> (forest.BITS - n)) for t in range(3) for k in keys[t]
        ]
        lengths = np.array(lengths).reshape(3, -1)
        level = next(n for n in range(forest.BITS, -1, -1) if (lengths >= n).sum() >= 60)
        for t in range(3):
            assert np.flatnonzero(lengths[t] >= level).tolist() == list(range(low[t, q], high[t, q]))
