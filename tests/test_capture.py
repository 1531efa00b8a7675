"""Change capture, the versioned fact and key checks."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseloom import schemas
from pulseloom.operators import capture
from pulseloom.operators.warehouse import PostFact
from pulseloom.session import materialise

REDDIT = "comment_id string, subreddit string, text string, score int, created_at timestamp_ntz, ingested_at timestamp_ntz"


def staging(spark, rows):
    text = spark.createDataFrame(rows, "comment_id string, text string, score int, at string")
    return text.select(
        "comment_id", F.lit(None).cast("string").alias("subreddit"), "text", "score",
        F.lit(None).cast("timestamp_ntz").alias("created_at"), F.col("at").cast("timestamp_ntz").alias("ingested_at"),
    )


def summary(row):
    names = ("staging_rows_raw", "staging_rows_deduped", "new", "updated", "unchanged")
    return tuple(row.first()[n] for n in names)


def test_insert_change_and_rerun(spark, tmp_path):
    fact = PostFact(spark, str(tmp_path))
    first = staging(spark, [("b1", "texte initial", 1, "2024-01-01"), ("b2", "stable", None, "2024-01-01")])
    assert summary(fact.transform_source(first, "raw_reddit", F.lit("2024-01-01"), 1)) == (2, 2, 2, 0, 0)
    both = first.unionByName(staging(spark, [("b1", "texte modifié", 99, "2024-01-02")]))
    assert summary(fact.transform_source(both, "raw_reddit", F.lit("2024-01-02"), 2)) == (3, 2, 0, 1, 1)
    versions = {(r["external_post_id"], r["is_current"]): r for r in fact.read(5).collect()}
    assert versions["b1", False]["text_content"] == "texte initial"
    assert str(versions["b1", False]["expiration_date"]) == "2024-01-02 00:00:00"
    assert versions["b1", True]["likes"] == 99 and versions["b1", True]["expiration_date"] is None
    assert len(versions) == 3 and len({r["post_id"] for r in versions.values()}) == 3
    assert summary(fact.transform_source(both, "raw_reddit", F.lit("2024-01-03"), 3)) == (3, 2, 0, 0, 2)
    assert fact.read(5).count() == 3
    before = fact.read(5).count()
    fact.transform_source(staging(spark, [("b9", "late", 1, "2024-01-04")]), "raw_reddit", F.lit("2024-01-04"), 3)
    assert fact.read(5).count() == before, "a batch id that was seen changes nothing"


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    fact = PostFact(spark, str(tmp_path), buckets=8)
    rows = [(f"k{i}", "t", i, "2024-01-01") for i in range(60)]
    assert summary(fact.transform_source(staging(spark, rows), "raw_reddit", F.lit("2024-01-01"), 1)) == (60, 60, 60, 0, 0)
    before = fact.bucket_paths(5)
    assert len(before) == 8
    # One changed row, one new one, and rows of all buckets that stay as they are.
    batch = [*rows[1:], ("k0", "t", 99, "2024-01-02"), ("new", "t", 1, "2024-01-02")]
    assert summary(fact.transform_source(staging(spark, batch), "raw_reddit", F.lit("2024-01-02"), 2)) == (61, 61, 1, 1, 59)
    after = PostFact(spark, str(tmp_path), buckets=3)
    assert after.buckets == 8, "a store keeps its number of buckets"
    assert 1 <= sum(before[b] != p for b, p in after.bucket_paths(5).items()) <= 2
    found = after.read(5)
    assert found.count() == 62 and found.where("is_current").count() == 61
    assert found.select("post_id").distinct().count() == 62 and found.agg(F.max("post_id")).first()[0] == 62


def test_a_batch_that_dies_before_its_pointers_is_not_seen(spark, tmp_path, monkeypatch):
    from pulseloom.operators import warehouse

    fact = PostFact(spark, str(tmp_path), buckets=4)
    fact.transform_source(staging(spark, [("a", "old", 1, "2024-01-01")]), "raw_reddit", F.lit("2024-01-01"), 1)

    def dies(*args):
        raise RuntimeError("lost")

    later = staging(spark, [("a", "new", 2, "2024-01-02"), ("b", "x", 2, "2024-01-02")])
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "number_versions", dies)
        try:
            fact.transform_source(later, "raw_reddit", F.lit("2024-01-02"), 2)
        except RuntimeError:
            pass
    assert [(r["external_post_id"], r["is_current"]) for r in fact.read(5).collect()] == [("a", True)]
    assert summary(fact.transform_source(later, "raw_reddit", F.lit("2024-01-02"), 2)) == (2, 2, 1, 1, 0)
    assert fact.read(5).count() == 3


def test_versions_follow_source_time(spark):
    """Rows dated no later than the version they would replace change nothing, whatever they say."""
    types = "source_id int, platform_id int, external_post_id string, text_content string, published_at timestamp_ntz, likes long, comments long, shares long, views long, ingested_at timestamp_ntz"
    batch = lambda *rows: spark.createDataFrame([(5, 4, k, t, None, n, None, None, None, None) for k, t, n, _ in rows], types.replace("ingested_at timestamp_ntz", "x string")).drop("x").join(
        spark.createDataFrame([(k, a) for k, _, _, a in rows], "external_post_id string, a string"), "external_post_id"
    ).withColumn("ingested_at", F.col("a").cast("timestamp_ntz")).drop("a")
    fact = spark.createDataFrame([], schemas.VERSIONED_FACT)
    stamp = F.col("ingested_at")
    fact = capture.scd2_apply(fact, batch(("a", "old", 1, "2024-01-01"), ("z", "z", 1, "2024-01-05")), stamp)
    fact = capture.scd2_apply(fact, batch(("a", "new", 2, "2024-01-02")), stamp, 2)
    # Older than the version of z, but later than nothing of a: only a's turn counts.
    fact = capture.scd2_apply(fact, batch(("a", "old", 1, "2024-01-01"), ("z", "late", 3, "2024-01-04")), stamp, 3)
    found = sorted((r["external_post_id"], r["text_content"], str(r["effective_date"])[:10], str(r["expiration_date"])[:10], r["is_current"]) for r in fact.collect())
    assert found == [
        ("a", "new", "2024-01-02", "None", True), ("a", "old", "2024-01-01", "2024-01-02", False), ("z", "z", "2024-01-05", "None", True),
    ]


def test_the_fact_is_shuffled_once(spark, tmp_path):
    fact = spark.createDataFrame([], schemas.VERSIONED_FACT)
    fact.write.parquet(str(tmp_path / "f"))
    stored = spark.read.schema(schemas.VERSIONED_FACT).parquet(str(tmp_path / "f"))
    staged = capture.dedupe_latest(capture.map_to_common(staging(spark, [("a", "t", 1, "2024-01-01")]), "raw_reddit"))
    merged = capture.merge_versions(stored, materialise(staged), F.lit("2024-01-02"), 8)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # One for the current versions, one for the batch.
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


def test_sources_do_not_touch_each_other(spark, tmp_path):
    fact = PostFact(spark, str(tmp_path))
    fact.transform_source(staging(spark, [("x", "a", 1, "2024-01-01")]), "raw_reddit", F.lit("2024-01-01"), 1)
    reviews = spark.createDataFrame([("x", "autre", 4.0)], "review_id string, text string, rating double").select(
        "*", F.lit(None).cast("timestamp_ntz").alias("review_date"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ingested_at")
    )
    fact.transform_source(reviews, "raw_allocine", F.lit("2024-01-02"), 1)
    assert sorted((r["source_id"], r["is_current"]) for r in fact.read().collect()) == [(4, True), (5, True)]


def test_empty_staging_gives_zeros_and_null_keys_are_set_apart(spark, tmp_path):
    fact = PostFact(spark, str(tmp_path))
    assert summary(fact.transform_source(staging(spark, []), "raw_reddit", F.lit("2024-01-01"), 1)) == (0, 0, 0, 0, 0)
    mapped = capture.map_to_common(staging(spark, [(None, "x", 1, "2024-01-01"), ("k", "y", 1, "2024-01-01")]), "raw_reddit")
    assert capture.null_key_rejects(mapped).count() == 1


def test_numeric_natural_key_is_cast(spark):
    tweets = spark.createDataFrame([(7, "a")], "tweet_id long, text string").withColumn("tweet_date", F.lit(None))
    assert capture.map_to_common(tweets, "raw_twitter_fr").first()["external_post_id"] == "7"


def test_seed_rows_insert_once(spark):
    rows = schemas.reference_rows(spark, "dim_platform")
    once = capture.insert_if_absent(rows.limit(0), rows, "platform_id")
    assert capture.insert_if_absent(once, rows, "platform_id").count() == 9


def test_key_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "source_id int")
    parent = spark.createDataFrame([(1,)], "source_id int")
    assert [r[0] for r in capture.check_foreign_key(child, "source_id", parent, "source_id").collect()] == [2]
    rows = spark.createDataFrame([("a", None), ("a", 1), (None, 1)], "k string, v int")
    found = {(r["violation"], r["column_name"]): r["row_count"] for r in capture.check_key_and_not_null(rows, "k", ["v"]).collect()}
    assert found == {("duplicate_key", "k"): 2, ("null_value", "k"): 1, ("null_value", "v"): 1}


def test_schema_changes_are_additive_only(spark):
    declared = {"t": StructType.fromDDL("a int, b string"), "u": StructType.fromDDL("x int")}
    actual = {"t": StructType.fromDDL("a bigint, old string")}
    diff = {(r["table_name"], r["column_name"], r["action"]) for r in capture.schema_diff(spark, declared, actual).collect()}
    assert diff == {("t", "b", "add_column"), ("u", "x", "create_table")}
    evolved = capture.evolve_schema(spark.createDataFrame([(1, "keep")], "a bigint, old string"), declared["t"])
    assert evolved.dtypes == [("a", "bigint"), ("old", "string"), ("b", "string")]
    assert evolved.first()["b"] is None


def test_stored_tables_are_migrated(spark, tmp_path):
    paths = {t: str(tmp_path / t) for t in ("t", "u", "v")}
    spark.createDataFrame([(1, "keep")], "a bigint, old string").write.parquet(paths["t"])
    spark.createDataFrame([(5,)], "x int").write.parquet(paths["v"])
    declared = {"t": StructType.fromDDL("a bigint, b string"), "u": StructType.fromDDL("x int"), "v": StructType.fromDDL("x int")}
    report = lambda **how: {(r["table_name"], r["column_name"], r["action"]) for r in capture.migrate(spark, declared, paths, **how).collect()}
    changes = {("t", "b", "add_column"), ("u", "x", "create_table")}
    assert report() == changes and report() == changes, "a dry run changes nothing"
    assert report(dry_run=False) == changes
    assert report() == set()
    rows = spark.read.option("mergeSchema", True).parquet(paths["t"])
    assert sorted(rows.columns) == ["a", "b", "old"] and [(r["a"], r["b"], r["old"]) for r in rows.collect()] == [(1, None, "keep")]
    assert capture.stored_schemas(spark, paths)["u"].names == ["x"]


def test_every_declared_table_parses(spark):
    tables = schemas.declared_tables()
    assert {"raw_reddit", "dim_model", "fact_social_post", "dq_checks"} <= set(tables)
    assert "source_file" in tables["raw_reddit"].names and "is_current" in tables["dim_model"].names
