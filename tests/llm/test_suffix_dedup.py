"""Suffix dedup against a look at every string of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseloom.llm import suffix_dedup
from pulseloom.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, width=suffix_dedup.WIDTH):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of texts given in order."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            string = data[p : p + width]
            if string in seen:
                gone[p : p + width] = True
            seen.add(string)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((doc, len(data), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(data, np.uint8)[~gone])))
    return out


def found(docs):
    df, names = suffix_dedup.deduplicate(docs, keep=["doc_id"])
    rows = df.collect()
    return sorted(
        [(r["doc_id"], r[names["n_bytes"]], r[names["n_removed"]], len(r[names["spans"]]), bytes(r[names["kept"]])) for r in rows],
        key=lambda r: (r[0] is not None, r),
    )


def passages(seed, n, alphabet="abcdefghij éß語", docs=60):
    pick = random.Random(seed)
    words = lambda size: "".join(pick.choice(alphabet) for _ in range(size))
    shared = [words(pick.choice([60, 99, 100, 101, 150, 400])) for _ in range(n)]
    rows = []
    for doc in range(docs):
        parts = [pick.choice(shared) if pick.random() < 0.6 else words(pick.randint(0, 120)) for _ in range(pick.randint(0, 5))]
        rows.append((doc, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(docs_of, seed):
    rows = passages(seed, 12)
    shuffled = random.Random(seed).sample(rows, len(rows))
    assert found(docs_of(shuffled)) == brute(rows)


def test_few_letters_and_runs(docs_of):
    rows = [*passages(3, 6, "ab", 30), (100, "a" * 450), (101, "xy" * 200), (102, "a" * 120 + "xy" * 70), (103, "abc" * 90 + "z" + "abc" * 90)]
    assert found(docs_of(rows)) == brute(rows)


def test_crowded_anchors_and_small_batches(docs_of, monkeypatch):
    line = "".join(random.Random(8).choice("abcdefgh ") for _ in range(80))
    pick = random.Random(9)
    rows = [(d, "".join(pick.choice("uvwx") for _ in range(30)) + line + pick.choice(["end" * 20, "tail" * 15, str(d) * 30])) for d in range(150)]
    expected = brute(rows)
    monkeypatch.setattr(suffix_dedup, "CROWDED", 10)
    assert found(docs_of(rows)) == expected
    monkeypatch.setattr(suffix_dedup, "CROWDED", 10_000)
    monkeypatch.setattr(suffix_dedup, "BATCH", 7)
    assert found(docs_of(rows)) == expected


def test_long_text_goes_in_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 500)
    rows = passages(5, 8, docs=12)
    rows.append((50, "".join(t for _, t in rows) * 2))
    assert found(docs_of(rows)) == brute(rows)


def test_odd_rows(docs_of):
    text = "".join(random.Random(4).choice("abcdef") for _ in range(130))
    docs = docs_of([(1, None), (2, ""), (3, "x" * 99), (4, text), (4, text), (4, text + "!"), (None, text), (5, "\0" * 150)], kept=7, spans="s", _doc=1, _Text=2)
    df, names = suffix_dedup.deduplicate(docs)
    rows = df.collect()
    assert names == {"n_bytes": "n_bytes", "n_removed": "n_removed", "spans": "spans_", "kept": "kept_"}
    assert {(r["kept"], r["spans"], r["_doc"], r["_Text"]) for r in rows} == {(7, "s", 1, 2)}
    by = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in rows)
    expected = [(0, 130, 0), (1, 0, 0), (2, 0, 0), (3, 99, 0), (4, 130, 130), (4, 130, 130), (4, 131, 130), (5, 150, 149)]
    assert by == expected


def test_empty_table(docs_of):
    assert found(docs_of([])) == []


def test_family_levels_grow_geometrically():
    family = suffix_dedup.SuffixFamily()
    pick = np.random.default_rng(1)
    seen, sizes = set(), []
    for _ in range(13):
        strings = np.array([b"%099d" % n + b"x" for n in pick.integers(0, 400, 50)], "S100")
        expected = []
        for s in strings.tolist():
            expected.append(s in seen)
            seen.add(s)
        assert family.add(strings).tolist() == expected
        sizes.append(sorted(family.levels))
    assert sum(map(len, family.levels.values())) == len(seen)
    assert sizes[7] == [3] and sizes[12] == [0, 2, 3]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = {tuple(r) for r in QUERIES["op13_suffix_family"](spark, SF_DIR).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    expected = brute(sorted((r[0], r[1]) for r in docs))
    assert rows == {(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in expected}
    assert any(r[2] for r in expected)
    assert len(rows) == len(docs)


def test_extra_columns_stay(docs_of):
    docs = docs_of([(1, "a")]).withColumn("n_removed", F.lit(3))
    df, names = suffix_dedup.deduplicate(docs)
    assert names["n_removed"] == "n_removed_"
    assert df.select("n_removed").first()[0] == 3
