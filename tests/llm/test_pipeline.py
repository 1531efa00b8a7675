import json

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "secret scans", "packing"]


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_queries_match_their_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    found = entry.queries()[name](spark, SMALL)
    assert sorted(found.columns) == sorted(want.columns)
    rows = sorted((tuple(r[c] for c in sorted(found.columns)) for r in found.collect()), key=str)
    assert rows == sorted(want.project(", ".join(sorted(found.columns))).fetchall(), key=str)


def test_stages_keep_columns_and_take_effect(spark, docs_of):
    """Each stage beside a plain version of its rule, over the smallest documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = corpus_pipeline.materialise(stage(spark, docs, SMALL), f"test-{n}")
        assert path.columns == docs.columns, name
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, path))
        assert after.keys() <= before.keys()
        if name == "exact dedup":
            keys = lambda texts: {"".join((t or "").translate({c: None for c in (32, 9, 10, 11, 12, 13)})) for t in texts}
            assert keys(after.values()) == keys(before.values()) and len(keys(after.values())) == len(after)
        if name == "near dedup":
            from test_minhash import brute

            kept = {r[0] for r in brute(list(before.items()), 5) if r[3]}
            assert after.keys() == kept
        if name == "secret scans":
            from test_secret_scan import brute_base

            assert after.keys() == before.keys() and not any(brute_base(t) for t in after.values())
            assert all(after[i] == before[i] for i in before if "AKIA" not in before[i] and "=" not in before[i] and not brute_base(before[i]))
        docs = path
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.collect()} == set(after)


def test_stages_on_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "one text here"), (3, "one text here"), (None, "no id"), (4, "word " * 3000), (5, "one  text here")]
    docs = docs_of(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SMALL), "odd")
    kept = sorted((r.doc_id for r in docs.collect()), key=str)
    assert kept == sorted([2, 4, 5, None], key=str) or kept == sorted([1, 4, 5, None], key=str)


def test_stages_on_no_rows(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SMALL), "empty")
    assert docs.count() == 0


def test_python_gets_bounded_batches(spark, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

    stage = lambda spark, docs, sf_dir: spark.range(0, 5000, 1, 1).mapInArrow(sizes, "rows long")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", stage)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.rows for r in corpus_pipeline.run(spark, SMALL).collect()] == [corpus_pipeline.BATCH_ROWS] * 5
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_run_alone_bound_their_batches(spark, docs_of, name, stage):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    before = {key: spark.conf.get(key) for key in corpus_pipeline.BATCH_SETTINGS}
    try:
        stage(spark, docs_of([(1, "some words here"), (2, None)]), SMALL)
        short = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "rows long, bytes long").collect()
        long = spark.range(0, 1000, 1, 1).selectExpr("id", "repeat('words ', 2000) as text").mapInArrow(sizes, "rows long, bytes long").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [r.rows for r in short] == [corpus_pipeline.BATCH_ROWS] * 5
    assert sum(r.rows for r in long) == 1000 and max(r.bytes for r in long) < 1.1 * corpus_pipeline.BATCH_BYTES


def test_entry_lists_are_plain_data():
    assert json.dumps(sorted(entry.oracle_sql()))
