import random

import numpy as np
import pytest

from pulseloom.llm import minhash
from pulseloom.llm.components import components


def brute(rows, width, percent=80):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if words and len(words) < width:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids) if ids and sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    # A chain, each link of which is just long enough.
    chain = [f"c{i}" for i in range(40)]
    for k in range(12):
        rows.append((len(rows), " ".join(chain[: 40 - 3 * k])))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "One two"), (506, "é É"), (507, "é é")]
    rows += [(600, "same words here"), (600, "same words here"), (None, "same words here"), (None, "nobody else has this")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_matches_brute_force(docs_of, width):
    rows = corpus()
    found = minhash.near_duplicates(docs_of(rows, kept="x", bucket=1, text_key="k"), width)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str)
    assert got == sorted(brute(rows, width), key=str)


def test_small_blocks_give_the_same(docs_of, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 2)
    rows = corpus(4)
    found = minhash.near_duplicates(docs_of(rows), 2)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=str)
    assert got == sorted(brute(rows, 2), key=str)


def test_survivors(docs_of):
    rows = corpus()
    docs = docs_of(rows, key="mine", Kept_key="own")
    found = minhash.survivors(docs, 2)
    assert found.columns == docs.columns
    kept = sorted({str(r[0]) for r in brute(rows, 2) if r[3]})
    assert sorted(str(r.doc_id) for r in found.collect()) == kept


def test_no_rows(docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0
    assert minhash.survivors(docs_of([])).count() == 0


def test_very_long_text(docs_of):
    text = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))
    found = minhash.near_duplicates(docs_of([(1, text), (2, text + " more"), (3, "x" * 200_000)]), 5).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3}


def test_coordinates_are_shifts_of_one_permutation():
    shingles = minhash.shingle_set("a b c d e f g h", 2)
    placed = (shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)
    first = minhash._permute32(placed.copy())
    for k in (0, 1, 77, minhash.COORDINATES - 1):
        assert minhash.signature(shingles)[k] == minhash._permute32(first - np.uint32(k)).min()
    values = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65_537)
    assert len(np.unique(minhash._permute32(values.copy()))) == len(values)


def test_equal_coordinates_estimate_the_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8):
        estimates = []
        for _ in range(30):
            both = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            rest = (400 - len(both)) // 2
            a, b = (np.unique(np.r_[both, rng.integers(0, 2**63, rest, dtype=np.uint64)]) for _ in range(2))
            a, b = a << np.uint64(1), b << np.uint64(1)
            estimates.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(estimates) - share) < 0.03


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(200, 200), (61, 60), (60, 59)]
    rng.shuffle(edges)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(40)} == {0}
    assert found[61] == found[59] == 59
