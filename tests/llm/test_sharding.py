import zlib
from collections import Counter

import pytest

from pulseloom.llm import sharding


def brute_walk(keys, positions, owners, capacity):
    """Key by key: all try their own node, then all that are left the next one."""
    place, used, waiting, step = {}, Counter(), [(sharding.nearest_node(positions, p), p, k) for k, p in keys], 0
    waiting.sort()
    while waiting:
        left = []
        for arc, p, k in waiting:
            shard = owners[(arc + step) % len(owners)]
            if used[shard] < capacity[shard]:
                used[shard] += 1
                place[k] = shard
            else:
                left.append((arc, p, k))
        waiting, step = left, step + 1
    return place


@pytest.mark.parametrize("slack", [0.0, 0.3])
def test_matches_a_walk_of_single_keys(docs_of, spark, slack):
    from pyspark.sql import functions as F

    docs = docs_of([(i, f"t{i}") for i in range(300)])
    found = sharding.assign(docs, 5, nodes=8, slack=slack)
    ring = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit("ring")).alias("p")).collect()
    positions, owners = sharding.ring(5, 8)
    want = brute_walk([(r.doc_id, r.p) for r in ring], positions, owners, sharding.capacities(300, 5, slack))
    assert {r.doc_id: r.shard for r in found.collect()} == want


def test_rows_law_slots_sizes_and_checksums(docs_of):
    rows = [(i, "é" * (i % 40)) for i in range(205)] + [(None, None)] * 90 + [(7, "same")] * 12
    found = sharding.assign(docs_of(rows), 24).collect()
    counts = Counter(r.shard for r in found)
    assert len(found) == len(rows) and max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want


def test_growth_moves_few_keys(docs_of):
    docs = docs_of([(i, "x") for i in range(4000)])
    for slack, most in ((0.0, 0.35), (0.25, 0.15)):
        old = {r.doc_id: r.shard for r in sharding.assign(docs, 24, slack=slack).collect()}
        new = {r.doc_id: r.shard for r in sharding.assign(docs, 25, slack=slack).collect()}
        assert sum(old[k] != new[k] for k in old) / len(old) < most


def test_fewer_rows_than_shards_and_none(docs_of):
    assert max(Counter(r.shard for r in sharding.assign(docs_of([(1, "a"), (2, "b")]), 24).collect()).values()) == 1
    assert sharding.assign(docs_of([]), 24).count() == 0
