"""Engagement, virality and sentiment models on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.functions.quantiles import exact_quantiles
from pulseloom.functions.text import WORD, tokens, unigrams_and_bigrams
from pulseloom.operators import terms
from pulseloom.operators.forest import ForestClassifier, ForestRegressor
from pulseloom.operators.splits import balanced_weights
from pulseloom.session import materialise

# The features, and the settings of the forests and of the text fit.
NUMERIC_FEATURES = [
    "followers", "account_age_days", "verified", "content_length", "num_hashtags", "sentiment_positive",
    "sentiment_negative", "sentiment_neutral", "hours_since_post",
]
CATEGORICAL_FEATURES = ["platform", "topic", "language", "media_type"]
TREES, DEPTH, SEED = 80, 16, 42
VOCABULARY, MIN_DOCUMENTS = 80_000, 3
CLUSTERS = (6, 8, 10)
TOLERANCE = 1e-4


# --- tabular features -----------------------------------------------------------------


def numeric_medians(train: DataFrame) -> dict[str, float]:
    """Exact train median per numeric feature, in one pass over an unpivoted frame."""
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in NUMERIC_FEATURES]
    long = train.select(F.inline(F.array(*entries)))
    found = exact_quantiles(long, ["name"], "v", {"median": 0.5})
    return {r["name"]: r["median"] or 0.0 for r in found.collect()}


def categorical_modes(train: DataFrame) -> dict[str, str]:
    """Most frequent train value per categorical feature; the smaller value on a tie."""
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in CATEGORICAL_FEATURES]
    counts = train.select(F.inline(F.array(*entries))).where("v is not null").groupBy("name", "v").count()
    best = counts.groupBy("name").agg(F.max(F.col("count")).alias("count"))
    top = counts.join(best, ["name", "count"]).groupBy("name").agg(F.min("v").alias("v"))
    return {r["name"]: r["v"] for r in top.collect()}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preprocessor(train: DataFrame) -> PipelineModel:
    """Median and mode fill, standardised numbers, one-hot categories.

    An unseen category becomes all zeros. The fills are literals of the fitted
    pipeline, so it can be saved and applied to a stream.
    """
    medians, modes = numeric_medians(train), categorical_modes(train)
    filled = [f"coalesce(cast({c} as double), {medians.get(c, 0.0)!r}D) as n_{c}" for c in NUMERIC_FEATURES]
    filled += [f"coalesce({c}, {_quoted(modes.get(c, ''))}) as f_{c}" for c in CATEGORICAL_FEATURES]
    stages = [
        SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__"),
        VectorAssembler(inputCols=[f"n_{c}" for c in NUMERIC_FEATURES], outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        StringIndexer(
            inputCols=[f"f_{c}" for c in CATEGORICAL_FEATURES],
            outputCols=[f"i_{c}" for c in CATEGORICAL_FEATURES],
            handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=[f"i_{c}" for c in CATEGORICAL_FEATURES],
            outputCols=[f"o_{c}" for c in CATEGORICAL_FEATURES],
            dropLast=True,
        ),
        VectorAssembler(inputCols=["_scaled", *[f"o_{c}" for c in CATEGORICAL_FEATURES]], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(train)


def fit_on_features(estimator: Estimator, train: DataFrame, preprocessor: PipelineModel | None = None) -> PipelineModel:
    """Fit preprocessing and model as one pipeline."""
    prepared = preprocessor or fit_preprocessor(train)
    columns = {"features", estimator.getLabelCol(), "weight"}
    data = train.transform(prepared.transform)
    return PipelineModel(stages=[*prepared.stages, estimator.fit(data.select(*[c for c in data.columns if c in columns]))])


def ridge(target: str, train: DataFrame, alpha: float = 1.0) -> LinearRegression:
    """A penalty of ``alpha`` on the summed squares.

    Spark's loss is a mean, and it scales the target to unit deviation before it
    applies the penalty, so both are undone here.
    """
    rows, deviation = train.agg(F.count(target), F.stddev_pop(target)).first()
    penalty = alpha * (deviation or 0.0) / max(1, rows)
    return LinearRegression(labelCol=target, elasticNetParam=0.0, regParam=penalty, standardization=False)


def forest_regressor(target: str, trees: int = TREES, depth: int = DEPTH) -> ForestRegressor:
    return ForestRegressor(labelCol=target, numTrees=trees, maxDepth=depth, seed=SEED)


def forest_classifier(label: str, trees: int = TREES, depth: int = DEPTH) -> ForestClassifier:
    return ForestClassifier(labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED)


def logistic(label: str, rows: int, max_iter: int = 500) -> LogisticRegression:
    """Unit inverse penalty on the summed loss is 1/n on Spark's mean loss."""
    return LogisticRegression(
        labelCol=label, weightCol="weight", maxIter=max_iter, regParam=1.0 / rows, standardization=False, tol=TOLERANCE
    )


def linear_svm(label: str, rows: int, max_iter: int = 100) -> LinearSVC:
    return LinearSVC(
        labelCol=label, weightCol="weight", maxIter=max_iter, regParam=1.0 / rows, standardization=False, tol=TOLERANCE
    )


def fit_balanced(make: Callable[[str, int], Estimator], train: DataFrame, label: str) -> PipelineModel:
    """Fit a classifier with class weights n / (classes * n_class)."""
    weighted = materialise(balanced_weights(train, label), "train")
    return fit_on_features(make(label, weighted.count()), weighted)


# --- text features --------------------------------------------------------------------


class SublinearTf(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Replace each term count by 1 + ln(count); Spark ML has no element-wise logarithm."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Whole batches of vectors at a time, as Arrow holds them.
        @F.arrow_udf(VectorUDT())
        def damp(v: pa.Array) -> pa.Array:
            counts = v.field("values")
            damped = pa.array(1.0 + np.log(counts.flatten().to_numpy(zero_copy_only=False)))
            sizes = np.append(0, np.cumsum(np.diff(counts.offsets.to_numpy())))
            values = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), damped, type=counts.type)
            return pa.StructArray.from_arrays([v.field("type"), v.field("size"), v.field("indices"), values], fields=list(v.type))

        return dataset.withColumn(self.getOutputCol(), damp(self.getInputCol()))


def _with_input(df: DataFrame, text: str) -> DataFrame:
    """The column the fitted text pipeline reads; a NULL text is the empty text."""
    return df.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))


def _term_totals(prepared: DataFrame) -> DataFrame:
    """(term, corpus_frequency, document_frequency) of the ``_terms`` lists, in one shuffle."""
    ordered = prepared.select(F.sort_array("_terms").alias("t"))
    # In a sorted list the first of equal terms stands for the document.
    # An inner explode would look for texts with terms below the shuffle, and take all texts apart twice.
    each = ordered.select("t", F.posexplode_outer("t").alias("i", "term")).where("term is not null")
    each = each.select("term", ((F.col("i") == 0) | (F.col("t")[F.greatest(F.col("i") - 1, F.lit(0))] != F.col("term"))).alias("first"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("corpus_frequency"), F.count_if("first").alias("document_frequency"))


def choose_vocabulary(totals: DataFrame, size: int, min_documents: float = MIN_DOCUMENTS) -> list[tuple[str, int]]:
    """The ``size`` most frequent terms that enough documents hold, with their document frequencies.

    Of equally frequent terms the first by name come in. A histogram of frequencies
    finds the frequency at which the list is full: all terms above it are taken, and
    only those of that frequency are put in order. At most ``size`` terms come to the
    driver.
    """
    enough = materialise(totals.where(F.col("document_frequency") >= min_documents), "terms")
    histogram = enough.groupBy("corpus_frequency").agg(F.count(F.lit(1)).alias("n"))
    # One row per distinct frequency, few at the top, where the list fills up.
    running = F.sum("n").over(Window.orderBy(F.col("corpus_frequency").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    full = histogram.withColumn("upto", running).where(F.col("upto") >= size).agg(F.max_by(F.struct("corpus_frequency", "n", "upto"), "corpus_frequency")).first()[0]
    columns = ("term", "document_frequency", "corpus_frequency")
    if full is None:
        taken = enough.select(*columns).collect()
    else:
        above = enough.where(F.col("corpus_frequency") > full["corpus_frequency"]).select(*columns).collect()
        room = size - (full["upto"] - full["n"])
        level = enough.where(F.col("corpus_frequency") == full["corpus_frequency"])
        taken = above + level.select(*columns).orderBy("term").limit(room).collect()
    taken.sort(key=lambda r: (-r["corpus_frequency"], r["term"]))
    return [(r["term"], r["document_frequency"]) for r in taken]


def fit_text_features(
    train: DataFrame, vocabulary: int, min_documents: float = MIN_DOCUMENTS
) -> PipelineModel:
    """Word 1-2-grams, sublinear counts, smoothed inverse document frequency plus one, unit length.

    Only the vocabulary and its document frequencies, at most ``vocabulary``
    entries, come to the driver.
    """
    splitting = PipelineModel(
        stages=[
            RegexTokenizer(inputCol="_text", outputCol="_words", gaps=False, pattern=f"[{WORD}]{{2,}}", toLowercase=True),
            NGram(n=2, inputCol="_words", outputCol="_pairs"),
            SQLTransformer(statement="select *, concat(_words, _pairs) as _terms from __THIS__"),
        ]
    )
    terms = choose_vocabulary(_term_totals(splitting.transform(train.select("_text"))), vocabulary, min_documents)
    if not terms:
        raise ValueError(f"no term is in {min_documents} documents")
    documents = train.count()
    counts = CountVectorizerModel.from_vocabulary([t for t, _ in terms], inputCol="_terms", outputCol="_counts")
    scale = Vectors.dense([math.log((1 + documents) / (1 + n)) + 1 for _, n in terms])
    return PipelineModel(
        stages=[
            *splitting.stages,
            counts,
            SublinearTf(inputCol="_counts", outputCol="_damped"),
            ElementwiseProduct(scalingVec=scale, inputCol="_damped", outputCol="_weighted"),
            Normalizer(p=2.0, inputCol="_weighted", outputCol="features"),
        ]
    )


_TEXT_SCRATCH = ["_text", "_words", "_pairs", "_terms", "_counts", "_damped", "_weighted"]


def fit_text_model(
    make: Callable[[str, int], Estimator], train: DataFrame, text: str = "text", label: str = "label", **features
) -> PipelineModel:
    """Text features, a class-balanced classifier, and predictions under the class names."""
    rows = train.count()
    weighted = materialise(balanced_weights(train.select(text, label), label), "train")
    weighted = _with_input(weighted, text)
    prepared = fit_text_features(weighted, **features)
    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(weighted)
    data = materialise(indexer.transform(prepared.transform(weighted)).select("features", "_label", "weight"), "features")
    model = make("_label", rows).fit(data)
    named = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=indexer.labels)
    return PipelineModel(stages=[*prepared.stages, model, named])


def class_names(model: PipelineModel) -> list[str]:
    return model.stages[-1].getLabels()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved pipeline; a missing one is an error of its own kind."""
    from pulseloom.sources.files import path_exists

    if not path_exists(SparkSession.active(), f"{path}/metadata"):
        raise FileNotFoundError(f"no saved model at {path}")
    return PipelineModel.load(path)


def predict_labels(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``predicted_label`` only; works for classifiers without probabilities."""
    scratch = [*_TEXT_SCRATCH, "features", "rawPrediction", "probability", "prediction"]
    return model.transform(_with_input(df, text)).drop(*scratch)


def score_text(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add sentiment_label, one probability per class name, and confidence.

    A NULL text scores as the empty text. Classes that the model does not know
    have probability 0.
    """
    if text not in df.columns:
        raise ValueError(f"no text column {text}")
    names = class_names(model)
    scored = model.transform(_with_input(df, text)).withColumn("_p", vector_to_array("probability"))
    found = {n: F.col("_p")[i] for i, n in enumerate(names)}
    zero = F.lit(0).cast("double")
    columns = {f"{n}_probability": found.get(n, zero) for n in ("positive", "negative", "neutral")}
    columns = {"sentiment_label": F.col("predicted_label"), **columns, "confidence": F.array_max("_p")}
    drop = [*_TEXT_SCRATCH, "features", "rawPrediction", "probability", "prediction", "predicted_label", "_p"]
    return scored.withColumns(columns).drop(*drop)


def score_candidates(
    posts: DataFrame,
    predictions: DataFrame,
    model_id: int,
    source_ids: list[int],
    resume: bool = True,
    max_rows: int | None = None,
    current_only: bool = False,
    keep: tuple[str, ...] | list[str] = ("post_id", "text_content"),
) -> DataFrame:
    """Posts with text that still lack a prediction by this model, first ids first.

    ``max_rows`` times the number of sources is one limit over all of them. All
    versions are scored unless ``current_only`` is set.
    """
    rows = posts.where(F.col("source_id").isin(source_ids) & F.col("text_content").isNotNull())
    if current_only:
        rows = rows.where("is_current")
    if resume:
        done = predictions.where(F.col("model_id") == model_id).select("post_id")
        rows = rows.join(done, "post_id", "left_anti")
    rows = rows.select(*keep)
    return rows if max_rows is None else rows.orderBy("post_id").limit(max_rows * len(source_ids))


def score_refresh(predictions: DataFrame, posts: DataFrame, model_id: int, source_ids: list[int]) -> DataFrame:
    """Stored predictions without those of this model on these sources."""
    mine = posts.where(F.col("source_id").isin(source_ids)).select("post_id", F.lit(model_id).alias("model_id"))
    return predictions.join(mine, ["post_id", "model_id"], "left_anti").select(*predictions.columns)


def append_predictions(predictions: DataFrame, scored: DataFrame, model_id: int) -> DataFrame:
    """New rows that the stored predictions do not hold yet; one per post and model.

    Prediction ids go on after the largest stored one, in order of the post.
    """
    fresh = scored.withColumn("model_id", F.lit(model_id)).dropDuplicates(["post_id", "model_id"])
    fresh = fresh.join(predictions.select("post_id", "model_id"), ["post_id", "model_id"], "left_anti")
    last = predictions.agg(F.max("prediction_id")).first()[0] or 0
    numbered = global_rank(fresh, [F.col("post_id")], "prediction_id", last)
    return numbered.withColumn("is_human_validated", F.lit(False))


def score_external(spark, model: PipelineModel, source: str, target: str, text: str = "text") -> int:
    """Score a structured file into another one; returns the number of rows."""
    from pulseloom.sources.files import scan_structured, sink_structured

    scored = score_text(model, scan_structured(spark, source), text).drop("neutral_probability")
    sink_structured(scored, target)
    return scan_structured(spark, target).count()


def discover_themes(df: DataFrame, clusters: int, text: str = "text", **features) -> DataFrame:
    """k-means on the text features: adds ``cluster``."""
    prepared = _with_input(df, text)
    data = materialise(fit_text_features(prepared, **features).transform(prepared).drop(*_TEXT_SCRATCH), "features")
    model = KMeans(k=clusters, seed=SEED, featuresCol="features", predictionCol="cluster").fit(data)
    return model.transform(data).drop("features")


def theme_search(
    df: DataFrame, key: str, ks: tuple[int, ...] = CLUSTERS, text: str = "text", terms: int = 10, **features
) -> tuple[DataFrame, DataFrame]:
    """k-means for each number of clusters over one feature table.

    Returns (key, k, cluster, silhouette) per text and number, the silhouette being that
    of the whole clustering by cosine distance, and (k, cluster, place, term, weight)
    with the heaviest terms of each centre.
    """
    spark, prepared = df.sparkSession, _with_input(df.select(key, text), text)
    pipeline = fit_text_features(prepared, **features)
    names = next(s for s in pipeline.stages if isinstance(s, CountVectorizerModel)).vocabulary
    data = materialise(pipeline.transform(prepared).select(key, "features"), "features")
    found, centres = [], []
    for k in ks:
        model = KMeans(k=k, seed=SEED, featuresCol="features", predictionCol="cluster").fit(data)
        # The features are written once; each clustering adds its labels only.
        placed = model.transform(data)
        clustered = materialise(placed.select(key, "cluster"), "clusters")
        judge = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", distanceMeasure="cosine")
        # One cluster, or none with texts, has no silhouette.
        several = clustered.select("cluster").distinct().count() > 1
        silhouette = F.lit(judge.evaluate(placed) if several else None).cast("double")
        found.append(clustered.select(key, F.lit(k).alias("k"), "cluster", silhouette.alias("silhouette")))
        for cluster, centre in enumerate(model.clusterCenters()):
            heaviest = sorted(range(len(names)), key=lambda i: (-centre[i], names[i]))[:terms]
            centres += [(k, cluster, place + 1, names[i], float(centre[i])) for place, i in enumerate(heaviest)]
    schema = "k int, cluster int, place int, term string, weight double"
    return reduce(DataFrame.unionByName, found), spark.createDataFrame(centres, schema)


# --- the same text features as a table -------------------------------------------------


def term_table(df: DataFrame, key: str, text: str, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(term, corpus_frequency, document_frequency, idf) of every term that enough documents hold."""
    return _terms(term_counts(df, key, text), df, min_documents)


def _terms(counts: DataFrame, df: DataFrame, min_documents: int) -> DataFrame:
    totals = (
        counts.groupBy("term")
        .agg(F.sum("term_count").alias("corpus_frequency"), F.count(F.lit(1)).alias("document_frequency"))
        .where(F.col("document_frequency") >= min_documents)
    )
    # One row.
    documents = df.agg(F.count(F.lit(1)).alias("_docs"))
    idf = F.log((F.lit(1) + F.col("_docs")) / (F.lit(1) + F.col("document_frequency"))) + F.lit(1)
    return totals.crossJoin(F.broadcast(documents)).withColumn("idf", idf).drop("_docs")


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, term_count) over words and neighbouring pairs.

    Texts are placed by key before they are taken apart. Counting per (key, term)
    then needs no further shuffle, and the shuffled text is smaller than its terms.
    """
    found = df.select(key, text).repartition(key).withColumn("_t", tokens(F.coalesce(F.col(text), F.lit(""))))
    exploded = found.select(key, F.explode(unigrams_and_bigrams(F.col("_t"))).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count(F.lit(1)).alias("term_count"))


def tfidf_features(df: DataFrame, key: str, text: str, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(key, term, tfidf): (1 + ln count) * idf at unit length per document.

    Terms are exchanged by hash, once per block of documents; the pairs do not move.
    """
    return terms.weights(df, key, text, min_documents)
