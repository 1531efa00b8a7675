"""Streams: late rows, replays, lost checkpoints and several models."""

import pytest
from pyspark.sql import functions as F

from pulseloom.operators.warehouse import PostFact
from pulseloom.plans.catalog.capture import STAGING
from pulseloom.streaming import jobs

POSTS = "post_id long, text_content string, published_at timestamp_ntz"
STAGED = "comment_id string, text string, score long, created_at timestamp_ntz, ingested_at timestamp_ntz"


class FakeModel:
    """Stands in for a fitted pipeline."""


@pytest.fixture
def scored(monkeypatch):
    def score(model, df, text):
        sizes = F.length(text).cast("double")
        return df.withColumns({"sentiment_label": F.lit("positive"), "confidence": sizes})

    monkeypatch.setattr(jobs, "score_text", score)



def posts(spark, folder, *rows):
    df = spark.createDataFrame([(i, t, d) for i, t, d in rows], "post_id long, text_content string, d string")
    df.select("post_id", "text_content", F.col("d").cast("timestamp_ntz").alias("published_at")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(POSTS).parquet(folder)


def test_late_posts_are_scored_and_repeats_are_not(spark, tmp_path, scored):
    folder, target = str(tmp_path / "posts"), str(tmp_path / "out")
    run = lambda s, check="c1", model=1: jobs.stream_score(s, FakeModel(), model, str(tmp_path / check), target)
    run(posts(spark, folder, (1, "a", "2024-02-01"), (1, "newer", "2024-02-02"), (9, None, "2024-02-02")))
    run(posts(spark, folder, (2, "bb", "2024-01-01"), (4, "no date", None)))
    found = run(posts(spark, folder, (3, "ccc", "2024-02-02"), (1, "again", "2024-03-01")))
    assert sorted((r.post_id, r.model_id, r.confidence) for r in found.collect()) == [(1, 1, 5.0), (2, 1, 2.0), (3, 1, 3.0), (4, 1, 7.0)]


def test_models_and_new_checkpoints_of_scores(spark, tmp_path, scored):
    folder, target = str(tmp_path / "posts"), str(tmp_path / "out")
    stream = posts(spark, folder, (1, "a", "2024-02-01"), (2, "b", "2024-02-01"))
    for check, model in (("c1", 1), ("c2", 2), ("c3", 1)):
        found = jobs.stream_score(stream, FakeModel(), model, str(tmp_path / check), target)
    assert sorted((r.post_id, r.model_id) for r in found.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_no_posts_give_no_predictions(spark, tmp_path, scored):
    folder = str(tmp_path / "posts")
    found = jobs.stream_score(posts(spark, folder), FakeModel(), 1, str(tmp_path / "c"), str(tmp_path / "out"))
    assert found.count() == 0 and "model_id" in found.columns


def test_ingest_after_a_lost_checkpoint(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("id,name\n1,x\n")
    ingest = jobs.StreamIngest(spark, str(tmp_path / "root"), "id int, name string")
    ingest.run(str(tmp_path / "drop"), str(tmp_path / "c1"))
    (tmp_path / "drop" / "b.csv").write_text("id,name\n2,y\n")
    ingest.run(str(tmp_path / "drop"), str(tmp_path / "c2"))
    ingest.run(str(tmp_path / "drop"), str(tmp_path / "c3"))
    assert sorted((r.id, r.name) for r in ingest.rows().collect()) == [(1, "x"), (2, "y")]
    assert sorted(r.status for r in ingest.ledger().collect()) == ["LOADED"] * 2 + ["SKIPPED_DUPLICATE"] * 3


def test_rows_without_a_ledger_entry_are_not_seen(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("id,name\n1,x\n")
    ingest = jobs.StreamIngest(spark, str(tmp_path / "root"), "id int, name string")
    dead = spark.createDataFrame([(1, "x", "a.csv")], "id int, name string, source_file string")
    dead.write.parquet(str(tmp_path / "root" / "rows" / "run_id=dead" / "batch_id=0"))
    assert ingest.rows().count() == 0
    ingest.run(str(tmp_path / "drop"), str(tmp_path / "c1"))
    assert [(r.id, r.name) for r in ingest.rows().collect()] == [(1, "x")]


def staged(spark, folder, *rows):
    df = spark.createDataFrame(rows, "comment_id string, text string, score long, a string")
    stamp = F.col("a").cast("timestamp_ntz")
    df.select("comment_id", "text", "score", stamp.alias("created_at"), stamp.alias("ingested_at")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(STAGED).parquet(folder)


def test_versions_after_a_lost_checkpoint(spark, tmp_path):
    folder, fact = str(tmp_path / "staged"), PostFact(spark, str(tmp_path))
    run = lambda stream, check: jobs.stream_scd2(stream, fact, STAGING, str(tmp_path / check))
    run(staged(spark, folder, ("a", "t", 1, "2024-01-01"), ("b", "t", 1, "2024-01-01")), "c1")
    stream = staged(spark, folder, ("a", "t", 2, "2024-01-02"))
    run(stream, "c1")
    run(stream, "c2")
    assert fact.read().count() == 3
    run(staged(spark, folder, ("c", "t", 1, "2024-01-03")), "c2")
    now = fact.read().where("is_current").collect()
    assert sorted((r.external_post_id, r.likes) for r in now) == [("a", 2), ("b", 1), ("c", 1)]
    assert fact.read().count() == 4 and fact.read().select("post_id").distinct().count() == 4


def test_a_replay_leaves_history_as_it_is(spark, tmp_path):
    """Old and new text arrive, then both come again after the checkpoint is lost, even in one batch."""
    folder, fact = str(tmp_path / "staged"), PostFact(spark, str(tmp_path))
    jobs.stream_scd2(staged(spark, folder, ("a", "old", 1, "2024-01-01")), fact, STAGING, str(tmp_path / "c1"))
    stream = staged(spark, folder, ("a", "new", 1, "2024-01-02"))
    jobs.stream_scd2(stream, fact, STAGING, str(tmp_path / "c1"))
    history = lambda: sorted(
        (r.post_id, r.text_content, str(r.effective_date)[:10], str(r.expiration_date)[:10], r.is_current) for r in fact.read().collect()
    )
    expected = [(1, "old", "2024-01-01", "2024-01-02", False), (2, "new", "2024-01-02", "None", True)]
    assert history() == expected
    jobs.stream_scd2(stream, fact, STAGING, str(tmp_path / "c2"))
    one_by_one = spark.readStream.schema(STAGED).option("maxFilesPerTrigger", 1).parquet(folder)
    jobs.stream_scd2(one_by_one, fact, STAGING, str(tmp_path / "c3"))
    assert history() == expected


def test_a_run_is_named_in_its_checkpoint(spark, tmp_path):
    first, again = (jobs.run_of(spark, str(tmp_path / "c1")) for _ in range(2))
    assert first == again and len(first) == 32
    assert jobs.run_of(spark, str(tmp_path / "c2")) != first


def test_a_batch_reads_no_predictions_of_its_own_run(spark, tmp_path, scored, monkeypatch):
    folder, target = str(tmp_path / "posts"), str(tmp_path / "out")
    jobs.stream_score(posts(spark, folder, (1, "a", "2024-02-01"), (2, "b", "2024-02-01")), FakeModel(), 1, str(tmp_path / "c1"), target)
    stream = posts(spark, folder, (1, "later", "2024-02-05"), (3, "c", "2024-02-05"), (None, "no id", "2024-02-05"))
    asked = []
    real = jobs.materialise
    monkeypatch.setattr(jobs, "materialise", lambda df, label="x": asked.append(label) or real(df, label))
    found = jobs.stream_score(stream, FakeModel(), 1, str(tmp_path / "c1"), target)
    assert "fresh" not in asked, "only the predictions of other runs are looked up"
    assert sorted((r.post_id or 0, r.confidence) for r in found.collect()) == [(0, 5.0), (1, 1.0), (2, 1.0), (3, 1.0)]
    found = jobs.stream_score(stream, FakeModel(), 1, str(tmp_path / "c2"), target)
    assert asked.count("fresh") == 1 and found.where("post_id is not null").count() == 3


def test_batches_of_one_run_stay_in_order(spark, tmp_path):
    fact = PostFact(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [(5, 1, "a", None, None, 1, None, None, None)],
        "source_id int, platform_id int, external_post_id string, text_content string, published_at timestamp_ntz, "
        "likes long, comments long, shares long, views long",
    )
    fact.apply(rows, 5, F.lit("2024-01-01"), 7, "run")
    fact.apply(rows, 5, F.lit("2024-01-01"), 7, "run")
    assert fact.seen(5, 7, "run") and not fact.seen(5, 7, "other") and not fact.seen(4, 7, "run")
    with pytest.raises(ValueError, match="comes after"):
        fact.apply(rows, 5, F.lit("2024-01-01"), 6, "run")


def test_posts_without_a_date_have_their_day(spark, tmp_path):
    folder = str(tmp_path / "kpi")
    schema = "published_at timestamp_ntz, total_engagement long, viral_coefficient double, toxicity_score double"
    run = lambda: jobs.stream_daily_kpi(spark.readStream.schema(schema).parquet(folder), str(tmp_path / "c"), str(tmp_path / "out"))
    for rows in ([("2024-02-01 10:00:00", 1)], [(None, 5), ("2024-01-01 10:00:00", 2), ("2024-02-01 23:00:00", 3)]):
        df = spark.createDataFrame(rows, "t string, total_engagement long")
        df.selectExpr(
            "cast(t as timestamp_ntz) as published_at", "total_engagement", "1e0 as viral_coefficient", "1e0 as toxicity_score"
        ).write.mode("append").parquet(folder)
        found = run()
    got = sorted(((str(r.activity_date), r.post_count, r.total_engagement) for r in found.collect()))
    assert got == [("2024-01-01", 1, 2), ("2024-02-01", 2, 4), ("None", 1, 5)]
