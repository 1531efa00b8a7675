"""Fitted models on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from pulseloom.operators import metrics, models, splits


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, ["bon film super", "mauvais film nul", "super bon", "nul mauvais triste"][i % 4] + " film" * (i % 3), ["positive", "negative"][i % 2]) for i in range(60)]
    return spark.createDataFrame(rows, "id long, text string, label string")


def test_text_vectors_equal_the_term_table(spark, texts):
    from pyspark.ml.functions import vector_to_array

    prepared = texts.withColumn("_text", F.col("text"))
    pipeline = models.fit_text_features(prepared, vocabulary=1000, min_documents=3)
    names = next(s for s in pipeline.stages if hasattr(s, "vocabulary")).vocabulary
    vectors = pipeline.transform(prepared).select("id", vector_to_array("features").alias("v")).collect()
    table = {(r["id"], r["term"]): r["tfidf"] for r in models.tfidf_features(texts, "id", "text", min_documents=3).collect()}
    for row in vectors:
        for name, value in zip(names, row["v"]):
            assert value == pytest.approx(table.get((row["id"], name), 0.0), abs=1e-9)
    idf = {r["term"]: r["idf"] for r in models.term_table(texts, "id", "text", min_documents=3).collect()}
    assert idf["triste"] == pytest.approx(math.log(61 / 16) + 1)


def test_sentiment_model_is_saved_and_scores_by_class_name(spark, texts, tmp_path):
    fitted = models.fit_text_model(lambda label, n: models.logistic(label, n, 50), texts, vocabulary=1000, min_documents=2)
    with pytest.raises(FileNotFoundError):
        models.load_model(str(tmp_path / "none"))
    models.save_model(fitted, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    news = spark.createDataFrame([(1, "super bon"), (2, "nul triste"), (3, None)], "id int, body string")
    rows = {r["id"]: r for r in models.score_text(loaded, news, "body").collect()}
    assert rows[1]["sentiment_label"] == "positive" and rows[2]["sentiment_label"] == "negative"
    assert rows[1]["positive_probability"] == rows[1]["confidence"] > 0.5 and rows[1]["neutral_probability"] == 0
    assert rows[3]["positive_probability"] + rows[3]["negative_probability"] == pytest.approx(1)
    with pytest.raises(ValueError):
        models.score_text(loaded, news, "text")
    news.select("id", F.col("body").alias("text")).write.parquet(str(tmp_path / "in.parquet"))
    assert models.score_external(spark, loaded, str(tmp_path / "in.parquet"), str(tmp_path / "out.jsonl")) == 3


def test_svm_separates(spark, texts):
    fitted = models.fit_text_model(models.linear_svm, texts, vocabulary=1000, min_documents=2)
    predicted = models.predict_labels(fitted, texts)
    assert metrics.macro_metrics(predicted, "label", "predicted_label").first()["f1_macro"] > 0.9


def test_resume_and_refresh(spark):
    posts = spark.createDataFrame([(i, 2 + i % 2, "t" if i else None) for i in range(10)], "post_id long, source_id int, text_content string")
    done = spark.createDataFrame([(1, 11), (2, 11), (3, 5)], "post_id long, model_id int")
    ids = lambda df: sorted(r["post_id"] for r in df.collect())
    assert ids(models.score_candidates(posts, done, 11, [2, 3])) == [3, 4, 5, 6, 7, 8, 9]
    assert ids(models.score_candidates(posts, done, 11, [3], max_rows=2)) == [3, 5]
    assert ids(models.score_candidates(posts, done, 11, [2, 3], resume=False)) == list(range(1, 10))
    assert ids(models.score_refresh(done, posts, 11, [2])) == [1, 3]


def test_models_beat_their_baseline_and_take_unseen_categories(spark):
    def rows(n, platform):
        return [(str(i), platform if i % 2 else "b", None if i % 9 == 0 else "x", "fr", "photo", i % 50, i, i % 3 == 0, i % 80, i % 4, 0.1, 0.2, 0.7, float(i % 24), float((i % 50) * 2 + (5 if i % 2 else 0))) for i in range(n)]

    schema = """post_id string, platform string, topic string, language string, media_type string, followers long,
        account_age_days long, verified boolean, content_length long, num_hashtags long, sentiment_positive double,
        sentiment_negative double, sentiment_neutral double, hours_since_post double, target double"""
    train, test = spark.createDataFrame(rows(300, "a"), schema), spark.createDataFrame(rows(60, "unseen"), schema)
    base = splits.baseline_regressor(train, "target", test)
    floor = metrics.regression_metrics(base, "target", "prediction").first()["mae"]
    for estimator in (models.ridge("target", train), models.forest_regressor("target", trees=5, depth=6)):
        predicted = models.fit_on_features(estimator, train).transform(test)
        assert metrics.regression_metrics(predicted, "target", "prediction").first()["mae"] < floor
    labelled = train.withColumn("viral", (F.col("target") > 80).cast("int"))
    for make in (models.logistic, lambda label, n: models.forest_classifier(label, trees=5, depth=6)):
        predicted = models.fit_balanced(make, labelled, "viral").transform(labelled)
        assert metrics.binary_metrics(predicted, "viral", "prediction").first()["f1_viral"] > 0.8


def test_runs_of_a_source_are_replaced(spark):
    new = metrics.run_row(spark, 3, 11, 3, "sentiment", 8, 2, {"model": "x", "max_features": 10}, "2024-01-02")
    assert new.first()["hyperparameters"] == '{"model":"x","max_features":10}'
    old = new.unionByName(new.withColumn("run_id", F.lit(1).cast("long"))).where("run_id = 1").unionByName(
        new.withColumn("run_id", F.lit(2).cast("long")).withColumn("source_id", F.lit(8))
    )
    scores = spark.createDataFrame([(0.5,)], "f1_macro double")
    rows = metrics.metric_rows(scores, 1, 1).unionByName(metrics.metric_rows(scores, 2, 2))
    runs, values = metrics.track_run(old, rows, new, metrics.metric_rows(scores, 3, 3), 3, "sentiment")
    assert sorted(r["run_id"] for r in runs.collect()) == sorted(r["run_id"] for r in values.collect()) == [2, 3]


def test_vocabulary_is_cut_by_frequency_then_name(spark):
    rows = [(t, n, n) for t, n in (("b", 5), ("a", 5), ("c", 5), ("top", 9), ("rare", 1), ("low", 3))]
    totals = spark.createDataFrame(rows, "term string, corpus_frequency long, document_frequency long")
    assert models.choose_vocabulary(totals, 3, 2) == [("top", 9), ("a", 5), ("b", 5)]
    assert [t for t, _ in models.choose_vocabulary(totals, 99, 2)] == ["top", "a", "b", "c", "low"]
    assert models.choose_vocabulary(totals.limit(0), 3, 2) == []


def test_terms_are_counted_once_per_document(spark):
    prepared = spark.createDataFrame([(["x", "y", "x"],), (["x"],), ([],)], "_terms array<string>")
    found = {r["term"]: (r["corpus_frequency"], r["document_frequency"]) for r in models._term_totals(prepared).collect()}
    assert found == {"x": (3, 2), "y": (1, 1)}


def test_each_text_is_nearest_to_its_own_centre(spark, texts):
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    found, centres = models.theme_search(texts, "id", (2, 3), terms=3, vocabulary=50, min_documents=2)
    rows = found.collect()
    assert {(r["k"], r["id"]) for r in rows} == {(k, i) for k in (2, 3) for i in range(60)}
    assert all(-1 <= r["silhouette"] <= 1 for r in rows) and centres.count() == 3 * 5
    prepared = texts.withColumn("_text", F.col("text"))
    vectors = {r["id"]: np.array(r["v"]) for r in models.fit_text_features(prepared, 50, 2).transform(prepared).select("id", vector_to_array("features").alias("v")).collect()}
    for k in (2, 3):
        groups = {}
        for r in rows:
            if r["k"] == k:
                groups.setdefault(r["cluster"], []).append(vectors[r["id"]])
        means = {c: np.mean(v, axis=0) for c, v in groups.items()}
        for r in rows:
            if r["k"] == k:
                distance = {c: np.linalg.norm(vectors[r["id"]] - m) for c, m in means.items()}
                assert distance[r["cluster"]] <= min(distance.values()) + 1e-6


def test_ridge_equals_the_closed_form(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    pick = np.random.default_rng(5)
    x, noise = pick.normal(size=(80, 4)), pick.normal(size=80)
    y = x @ [1.0, -2.0, 0.5, 0.0] + 3 + noise
    df = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "target"])
    fitted = models.ridge("target", df, 1.0).fit(df)
    centred = x - x.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(4), centred.T @ (y - y.mean()))
    expected = centred @ weights + y.mean()
    found = [r["prediction"] for r in fitted.transform(df).select("prediction").collect()]
    assert np.abs(np.array(found) - expected).max() < 1e-6


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    from pulseloom.operators import predictions

    def score(model, df, text):
        half = F.lit(0.5)
        return df.withColumns(
            {"sentiment_label": F.lit(model), "positive_probability": half, "negative_probability": half, "neutral_probability": F.lit(0.0), "confidence": half}
        )

    monkeypatch.setattr(predictions, "score_text", score)
    return predictions.PredictionStore(spark, str(tmp_path / "store"))


def _stored_posts(spark):
    return spark.createDataFrame([(i, 2 + i % 3, "t" if i else None, True) for i in range(12)], "post_id long, source_id int, text_content string, is_current boolean")


def _held(df):
    return sorted((r["post_id"], r["model_id"], r["sentiment_label"]) for r in df.collect())


def test_predictions_resume_and_refresh(spark, store):
    posts = _stored_posts(spark)
    assert store.read().count() == 0 and store.version() == 0
    assert store.score("old", posts, 11, [2], max_rows=2) == 2
    assert store.score("old", posts, 11, [2, 3]) == 5
    assert store.score("old", posts, 11, [2, 3]) == 0, "nothing is due"
    assert store.score("other", posts, 5, [2]) == 3
    before = store.version()
    assert store.score("new", posts, 11, [2], resume=False) == 3
    found = _held(store.read())
    assert found == sorted([(i, 11, "new") for i in (3, 6, 9)] + [(i, 11, "old") for i in (1, 4, 7, 10)] + [(i, 5, "other") for i in (3, 6, 9)])
    assert {label for _, m, label in _held(store.read(version=before)) if m == 11} == {"old"}
    ids = [r["prediction_id"] for r in store.read().collect()]
    assert len(set(ids)) == len(ids) and max(ids) == 13


def test_a_refresh_that_dies_leaves_the_old_predictions(spark, store, monkeypatch):
    from pulseloom.operators import predictions

    posts = _stored_posts(spark)
    store.score("old", posts, 11, [2, 3, 4])
    before = _held(store.read())

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(predictions, "read_or_empty", lambda spark, path, schema, real=predictions.read_or_empty: dies() if "commit=" in path else real(spark, path, schema))
        with pytest.raises(RuntimeError):
            store.score("new", posts, 11, [2, 3, 4], resume=False)
    assert _held(store.read()) == before
    store.score("new", posts, 11, [4], resume=False)
    assert {label for _, _, label in _held(store.read(source_ids=[4]))} == {"new"}
    assert {label for _, _, label in _held(store.read(source_ids=[2, 3]))} == {"old"}


def test_the_cut_equals_the_global_ranks(spark):
    from pulseloom.operators.splits import chronological_cut, chronological_split, nth_row

    rows = [(i, None if i % 40 == 0 else f"2024-01-{1 + i % 3:02d} 0{i % 4}:00:00") for i in range(200)]
    posts = spark.createDataFrame(rows, "post_id long, t string").select("post_id", F.col("t").cast("timestamp_ntz").alias("published_at"))
    ranked = {r["post_id"]: r["time_rank"] for r in chronological_split(posts).select("post_id", "time_rank").collect()}
    for share in (0.8, 0.01, 0.37, 1.0, 0.0):
        cut = posts.where(chronological_cut(posts, share=share)).collect()
        assert {r["post_id"] for r in cut} == {i for i, n in ranked.items() if n <= int(200 * share)}
    assert nth_row(posts, "published_at", "post_id", 201) is None
    one = posts.withColumn("published_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert {r["post_id"] for r in one.where(chronological_cut(one)).collect()} == set(range(160))


def test_metrics_of_several_models_become_tracked_rows(spark):
    rows = [("m1", "fr", "a", "a"), ("m1", "fr", "b", "a"), ("m1", None, "a", "b"), ("m2", "en", "a", "a"), ("m2", "en", "b", "b")]
    df = spark.createDataFrame(rows, "model string, language string, label string, predicted string")
    found = metrics.stacked_metrics(df, "label", "predicted")
    assert {(r["model"], r["scope"], r["language"]) for r in found.collect()} == {("m1", "all", None), ("m1", "language", "fr"), ("m2", "all", None), ("m2", "language", "en")}
    for model in ("m1", "m2"):
        alone = metrics.macro_metrics(df.where(F.col("model") == model), "label", "predicted").first()
        whole = found.where((F.col("model") == model) & (F.col("scope") == "all")).first()
        assert all(whole[n] == pytest.approx(alone[n]) for n in alone.asDict())
    tracked = {(r["run_id"], r["metric_name"]): r["metric_value"] for r in metrics.language_metric_rows(found, {"m1": 7, "m2": 8}).collect()}
    assert len(tracked) == 2 * (4 + 2) and tracked[8, "f1_macro_en"] == 1.0 and (7, "precision_macro_fr") not in tracked


def test_counts_are_damped_by_batches(spark):
    """Each vector went through Python objects of its own; no term, and one term, are damped too."""
    from pyspark.ml.linalg import SparseVector, Vectors

    rows = [(SparseVector(5, [1, 3], [1.0, math.e]),), (SparseVector(5, [], []),), (SparseVector(5, [4], [9.0]),)]
    df = spark.createDataFrame(rows, ["c"]).coalesce(1)
    damped = models.SublinearTf(inputCol="c", outputCol="d").transform(df)
    plan = damped._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and [r["d"] for r in damped.collect()] == [
        SparseVector(5, [1, 3], [1.0, 2.0]), SparseVector(5, [], []), SparseVector(5, [4], [1 + math.log(9)])
    ]
    assert all(isinstance(r["d"], type(Vectors.sparse(1, []))) for r in damped.collect())


def test_features_are_written_once_for_all_clusterings(spark, texts, monkeypatch):
    """They were written again beside the labels of each number of clusters."""
    written, real = [], models.materialise
    monkeypatch.setattr(models, "materialise", lambda df, label="frame": written.append((label, df.columns)) or real(df, label))
    models.theme_search(texts, "id", (2, 3), terms=3, vocabulary=50, min_documents=2)
    assert [label for label, columns in written if "features" in columns] == ["features"]
    assert [columns for label, columns in written if label == "clusters"] == [["id", "cluster"]] * 2


def test_texts_are_taken_apart_once_for_the_totals(spark):
    """An inner explode looks for texts with terms below the shuffle, and splits them there too."""
    dealt = spark.createDataFrame([("a b a",), ("",)], "s string").repartition(3)
    totals = models._term_totals(dealt.select(F.split("s", " ").alias("_terms")))
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    assert {r["term"]: (r["corpus_frequency"], r["document_frequency"]) for r in totals.collect()}["a"] == (2, 1)
