"""Quality, themes, behaviour, metrics and serving on hand-made rows."""

import re

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import behavior, metrics, quality, serving, splits, themes
from pulseloom.operators.themes import Taxonomy

TAXONOMY = Taxonomy({"evenement": ["gala", "ceremonie"], "politique": ["vote", "war", "senat"]})


def checks(df):
    return {r["check_name"]: (r["check_result"], r["rows_failed"]) for r in df.collect()}


def test_null_rate_and_negative_counters(spark):
    rows = spark.createDataFrame([("a", None, -15), ("b", None, 1), ("c", "x", 2), ("d", "y", 3)], "comment_id string, text string, score int")
    found = checks(quality.quality_suite(rows, "raw_reddit", ["comment_id", "text"]))
    assert found["null_rate_text"] == ("WARN", 2) and found["null_rate_comment_id"] == ("PASS", 0)
    assert not any("non_negative" in name for name in found), "a net score may be negative"
    likes = spark.createDataFrame([(-5,), (3,)], "likes int")
    assert checks(quality.quality_suite(likes, "t", []))["type_consistency_likes_non_negative"] == ("WARN", 1)


def test_range_total_duplicates_and_empty(spark):
    rows = spark.createDataFrame(
        [("q1", 1.2, 0.4, 10, 2, 3, 15), ("q2", 0.4, 101.4, 10, 2, 3, 99)],
        "post_id string, sentiment_positive double, toxicity_score double, likes long, shares long, comments long, total_engagement long",
    )
    found = checks(quality.quality_suite(rows, "posts", ["post_id"], main_corpus=True))
    assert found["range_sentiment_positive"] == ("WARN", 1)
    assert found["range_toxicity_score"] == ("WARN", 1)
    assert found["engagement_total_consistent"] == ("WARN", 1)
    assert found["duplicate_rate"] == ("PASS", 0)
    doubled = checks(quality.quality_suite(spark.createDataFrame([(1, None), (1, None)], "a int, b int"), "t", []))
    assert doubled["duplicate_rate"] == ("WARN", 1), "rows with a NULL count too"
    assert checks(quality.quality_suite(rows.limit(0), "posts", []))["row_count_positive"] == ("FAIL", 1)


def test_one_empty_column_is_info_and_several_a_warning(spark):
    rows = spark.createDataFrame([(1, "a", None)], "a int, b string, c string")
    assert quality.diagnose_empty_columns(rows).first()["severity"] == "INFO"
    wrong = spark.createDataFrame([(1, None, None)], "a int, b string, c string")
    assert quality.diagnose_empty_columns(wrong).first()["severity"] == "WARN"
    assert quality.diagnose_empty_columns(rows.select("a", "b")).count() == 0


def label(spark, text, taxonomy=TAXONOMY):
    row = themes.classify_theme(spark.createDataFrame([(text,)], "t string"), "t", taxonomy).first()
    return row["theme"], row["match_count"]


def test_theme_rules(spark):
    assert label(spark, "Le vote au senat") == ("politique", 2)
    assert label(spark, "A warm award today") == ("non_classe", 0)
    assert label(spark, "Le gala avant le vote") == ("evenement", 1)
    assert label(spark, "vote vote VOTE") == ("politique", 1)
    assert label(spark, "") == label(spark, None) == ("non_classe", 0)
    strict = Taxonomy(TAXONOMY.themes, min_occurrences=2)
    assert label(spark, "un vote", strict) == ("non_classe", 0)


def test_keyword_hits_equal_python_regular_expressions(spark):
    lexicon = Taxonomy({"a": ["Sénat", "vote", "special counsel", "c++", "g20", "la"], "b": ["north korea", "SKI", "où", "tax"]})
    texts = [
        "Le SÉNAT; évote, vote.", "special  counsel", "Special Counsel's c++ ok", "c++x g20", "NORTH KOREA_x north korea",
        "la où l'eau", "ſki Kelvin", "taxe tax_ TAX", "devote\tvote\nLA", None, "G20!", "sénateur sénat",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r["i"]: [set(h["keywords"]) for h in r["hits"]] for r in themes.keyword_hits(df, "t", lexicon).collect()}
    for i, text in enumerate(texts):
        expected = [
            {k for k in terms if re.search(rf"\b{re.escape(k)}\b", text or "", re.IGNORECASE)} for terms in lexicon.themes.values()
        ]
        assert found[i] == expected, text


def test_taxonomy_is_read_from_a_file(tmp_path):
    path = tmp_path / "t.yaml"
    path.write_text("min_occurrences: 2\nfallback: autre\nthemes:\n  a:\n    description: x\n    mots_cles: [un, 20]\n")
    read = Taxonomy.read(str(path))
    assert read == Taxonomy({"a": ["un", "20"]}, 2, "autre")


@pytest.fixture(scope="module")
def comments(spark):
    rows = [("c1", "p1", "ana", "bravo", "2024-01-06 12:30:00", "BBC"), ("c2", "p1", "ana", "   ", "2024-01-06 13:00:00", "BBC"),
            ("c3", "p1", "bob", None, "2024-01-06 13:00:00", "BBC"), ("c4", "p2", "bob", "tôt", "2024-01-05 09:00:00", "CNN")]
    rows += [(f"m{i}", "p2", "max", "encore", f"2024-01-07 {10 + i % 3}:00:00", "CNN") for i in range(12)]
    rows += [(f"t{i}", "p1", "tri", "oui", "2024-01-08 10:00:00", "BBC") for i in range(3)]
    df = spark.createDataFrame(rows, "id_commentaire string, id_publication string, pseudo_auteur string, texte string, at string, ecole string")
    post = F.when(F.col("id_publication") == "p1", "Le vote au senat").otherwise("rien")
    return df.select(
        "*", F.col("at").cast("timestamp_ntz").alias("date_commentaire"), F.lit("2024-01-06 10:00:00").cast("timestamp_ntz").alias("date_publication"),
        F.lit("fr").alias("langue"), F.lit("photo").alias("type_contenu"), post.alias("texte_publication"), F.lit(5).alias("likes"), F.lit(1).alias("partages"),
    )


def test_behaviour_layer(spark, comments):
    dims = themes.build_post_theme(themes.posts_from_comments(comments), TAXONOMY)
    assert {r["external_post_id"]: (r["theme"], r["matched_keywords"]) for r in dims.collect()} == {
        "p1": ("politique", "vote, senat"), "p2": ("non_classe", ""),
    }
    context = behavior.comment_context(comments, dims)
    rows = {r["comment_id"]: r for r in context.collect()}
    assert "c2" not in rows and "c3" not in rows
    assert rows["c1"]["reaction_delay_hours"] == 2.5 and rows["c1"]["theme"] == "politique" and rows["c1"]["is_weekend"]
    assert behavior.negative_delay_count(context).first()["negative_count"] == 1
    authors = {r["author_pseudo"]: r for r in behavior.author_profile(context).collect()}
    assert {a: r["segment"] for a, r in authors.items()} == {"ana": "ponctuel", "tri": "regulier", "max": "hyperactif"}
    assert authors["max"]["distinct_pages"] == 1 and authors["max"]["active_days"] == 1
    reaction = {(r["theme"], r["page_name"]): r for r in behavior.theme_reaction(context, dims).collect()}
    assert set(reaction) == {("politique", "BBC"), ("non_classe", "CNN")}
    assert reaction["politique", "BBC"]["comment_count"] == 4 and reaction["politique", "BBC"]["median_post_likes"] == 5
    hours = behavior.hourly_activity(context).collect()
    assert len(hours) == 24 and sum(r["comment_count"] for r in hours) == 16
    assert behavior.hour_peak_trough(behavior.hourly_activity(context)).first()["amplitude"] == 0


def test_average_precision_takes_ties_together(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.4), (0, 0.1)]
    found = metrics.average_precision(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["pr_auc"]
    assert found == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)


def test_undefined_metrics_are_zero(spark):
    row = metrics.binary_metrics(spark.createDataFrame([(0, 0), (1, 0)], "y int, p int"), "y", "p").first()
    assert (row["f1_viral"], row["precision_viral"], row["recall_viral"], row["balanced_accuracy"]) == (0, 0, 0, 0.5)


def test_small_corpus_is_refused_and_unseen_platform_is_not_viral(spark):
    tiny = spark.createDataFrame([("1", "2024-01-01")], "post_id string, published_at string")
    with pytest.raises(ValueError):
        splits.chronological_split(tiny)
    train = spark.createDataFrame([("a", float(i)) for i in range(11)], "platform string, viral_coefficient double")
    rows = spark.createDataFrame([("a", 9.0), ("a", 8.9), ("new", 99.0), (None, 1.0)], "platform string, viral_coefficient double")
    found = {(r["platform"], r["viral_coefficient"]): r["viral"] for r in splits.viral_label(train, rows).collect()}
    assert found == {("a", 9.0): 1, ("a", 8.9): 0, ("new", 99.0): 0, (None, 1.0): 0}


def test_sample_quotas_add_up(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 == 0, "x").otherwise("y").alias("label"))
    sample = splits.stratified_sample(df, "id", "label", 101)
    assert sample.count() == 101
    assert splits.stratified_sample(df, "id", "label", 5000).count() == 1000


def test_alert_threshold_and_null_toxicity(spark):
    kpis = spark.createDataFrame([("a", 1, 1.0, 2.0, 55.0), ("b", 1, 1.0, 3.0, None)],
                                 "platform_name string, post_count long, median_engagement double, average_engagement_rate double, average_toxicity double")
    alerts = serving.alerts_build(kpis, F.lit("2024-01-01")).collect()
    assert [(r["alert_id"], r["platform_name"], r["evidence"]) for r in alerts] == [(1, "a", '{"average_toxicity":55.0}')]
    ranked = serving.recommendations_ranked(serving.recommendations_build(kpis, F.lit("2024-01-01"))).collect()
    assert [r["platform_name"] for r in ranked] == ["b", "a"]
    assert serving.recommendations_build(kpis.limit(0), F.lit("2024-01-01")).count() == 0


def test_page_limits_scope_and_unknown_run(spark):
    posts = spark.range(10).select(
        F.col("id").alias("post_id"), (F.col("id") % 2).alias("source_id"), *[F.lit(None).alias(c) for c in serving.POST_COLUMNS[2:]]
    )
    assert [r["post_id"] for r in serving.posts_page(posts, source_id=1, limit=2, offset=1).collect()] == [3, 5]
    with pytest.raises(ValueError):
        serving.posts_page(posts, limit=501)
    assert serving.posts_scoped(posts, "scoped_admin", 0).count() == 5
    assert serving.posts_scoped(posts, "institution_admin", None).count() == 10
    runs = spark.createDataFrame([(1,)], "run_id long")
    with pytest.raises(LookupError):
        serving.run_metrics(runs, runs, 2)
