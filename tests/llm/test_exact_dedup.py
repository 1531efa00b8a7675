import hashlib
import re

from pulseloom.llm import exact_dedup as dedup

ROWS = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \t\n"), (7, "ab\x0b\x0c"), (8, "a\xa0b"), (None, "ab"),
    (9, "x" * 50_000), (10, "x" * 50_000 + " "), (11, "alone"), (11, "alone"),
]


def brute(rows):
    key = {i: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest() for i, (_, t) in enumerate(rows)}
    out = []
    for n, (doc_id, _) in enumerate(rows):
        same = [rows[m] for m in key if key[m] == key[n]]
        best = min(same, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        out.append((doc_id, best, len(same), doc_id == best, key[n]))
    return out


def by_row(rows):
    return sorted(rows, key=str)


def test_matches_brute_force(docs_of, spark):
    found = dedup.decide(docs_of(ROWS), dedup.fresh_index(spark)).collect()
    assert by_row(map(tuple, found)) == by_row(brute(ROWS))


def test_later_batches_lose_to_the_index(docs_of, spark):
    index = dedup.fresh_index(spark)
    dedup.decide(docs_of([(5, "one"), (6, "two")]), index).collect()
    second = docs_of([(1, "o n e  "), (7, "three"), (8, "three")])
    found = {r.doc_id: (r.keep_id, r.kept) for r in dedup.decide(second, index).collect()}
    assert found == {1: (5, False), 7: (7, True), 8: (7, False)}
    assert index.read(spark).count() == 3
    again = {r.doc_id: r.kept for r in dedup.decide(second, index).collect()}
    assert again == {1: False, 7: True, 8: False}
    assert index.read(spark).count() == 3


def test_index_is_found_again_by_its_path(docs_of, spark):
    from pulseloom.session import scratch_path

    path = scratch_path(spark, "kept-index")
    index = dedup.DigestIndex.open(spark, path, 4)
    dedup.decide(docs_of([(1, "one")]), index).collect()
    spark.sql(f"drop table {index.table}")
    reopened = dedup.DigestIndex.open(spark, path, 4)
    assert [r.keep_id for r in reopened.read(spark).collect()] == [1]


def test_survivors_keep_columns_and_come_once(docs_of, spark):
    docs = docs_of(ROWS, keep_id="mine", digest="own", kept_id=1)
    found = dedup.survivors(docs, dedup.fresh_index(spark))
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == [3, 6, 8, 10, 11]
    assert {(r.keep_id, r.digest, r.kept_id) for r in found.collect()} == {("mine", "own", 1)}


def test_no_rows(docs_of, spark):
    assert dedup.decide(docs_of([]), dedup.fresh_index(spark)).count() == 0
    assert dedup.survivors(docs_of([]), dedup.fresh_index(spark)).count() == 0


def test_only_built_in_functions_and_a_merge_join(docs_of, spark):
    index = dedup.fresh_index(spark)
    found = dedup.decide(docs_of(ROWS), index)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Python" not in plan and "Arrow" not in plan
