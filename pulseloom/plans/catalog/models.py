"""Model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.operators import metrics, models, splits
from pulseloom.operators.predictions import PredictionStore
from pulseloom.plans.bindings import dealt, table, view
from pulseloom.plans.registry import query
from pulseloom.session import materialise, scratch_path, shared_dir

_LABEL = "label"


def inputs_digest(spark, sf_dir, tables):
    """Stands for the files of some tables: their names, times and lengths, nothing of their content."""
    paths = [f"{sf_dir}/{t}.parquet" for t in tables]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    found = files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("h"), F.count(F.lit(1)).alias("n")).first()
    return f"{found['n']}-{(found['h'] or 0) & 0xFFFFFFFFFFFFFFFF:016x}"


def fitted_once(spark, sf_dir, name, tables, fit):
    """The model of this name over these tables: loaded if one is saved in the shared folder, else fitted and saved."""
    path = f"{shared_dir(spark)}/models/{name}-{inputs_digest(spark, sf_dir, tables)}"
    try:
        return models.load_model(path)
    except FileNotFoundError:
        models.save_model(fit(), path)
        # Every key scores with the model as it is saved.
        return models.load_model(path)


_POST_TABLES = ["orders", "customer", "nation", "region", "lineitem"]


def split_posts(spark, sf_dir):
    """The main corpus with its chronological split and log target."""
    posts = view(spark, sf_dir, "posts")
    split = posts.withColumn("is_train", splits.chronological_cut(posts))
    return split.withColumn("target", splits.log_engagement(F.col("total_engagement")))


def _train_test(split):
    # Posts without engagement have no target.
    known = materialise(split.where(F.col("target").isNotNull()), "split")
    return known.where("is_train"), known.where(~F.col("is_train"))


@query("chronological_split", "select post_id, published_at, time_rank, is_train from split")
def chronological_split(spark, sf_dir):
    split = splits.chronological_split(view(spark, sf_dir, "posts"))
    return split.select("post_id", "published_at", "time_rank", "is_train")


_FILLED = ", ".join(
    f"round(coalesce(cast({c} as double), (select median(cast({c} as double)) from posts)), 6) as n_{c}"
    for c in models.NUMERIC_FEATURES
)
_MODES = ", ".join(
    f"coalesce({c}, (select {c} from posts where {c} is not null group by {c} order by count(*) desc, {c} limit 1)) as f_{c}"
    for c in models.CATEGORICAL_FEATURES
)
_WIDTH = " + ".join(f"(select count(distinct {c}) from posts)" for c in models.CATEGORICAL_FEATURES)


@query(
    "feature_preprocess",
    f"select post_id, cast({len(models.NUMERIC_FEATURES)} + {_WIDTH} as int) as feature_count, {_FILLED}, {_MODES} from posts",
)
def feature_preprocess(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    posts = materialise(view(spark, sf_dir, "posts"), "posts")
    prepared = models.fit_preprocessor(posts).transform(posts)
    return prepared.select("post_id", F.size(vector_to_array("features")).alias("feature_count"),
                           *[f"n_{c}" for c in models.NUMERIC_FEATURES], *[f"f_{c}" for c in models.CATEGORICAL_FEATURES])


@query("feature_fill", f"select post_id, {_FILLED}, {_MODES} from posts")
def feature_fill(spark, sf_dir):
    return feature_preprocess(spark, sf_dir).drop("feature_count")


@query(
    "log_engagement",
    "select post_id, round(case when total_engagement is null then null else ln(1 + greatest(total_engagement, 0)) end, 6) as target from posts",
)
def log_engagement(spark, sf_dir):
    return view(spark, sf_dir, "posts").select("post_id", splits.log_engagement(F.col("total_engagement")).alias("target"))


@query(
    "baseline_regressor",
    """select post_id, round((select median(ln(1 + greatest(total_engagement, 0))) from split
         where is_train and total_engagement is not null), 6) as prediction from split where not is_train""",
)
def baseline_regressor(spark, sf_dir):
    split = split_posts(spark, sf_dir).select("post_id", "target", "is_train")
    rows = split.where(~F.col("is_train")).select("post_id")
    return splits.baseline_regressor(split.where("is_train"), "target", rows)


def _regressor(spark, sf_dir, name):
    """A saved engagement model, its training and its test posts."""
    train, test = _train_test(split_posts(spark, sf_dir))
    make = {"ridge": lambda: models.ridge("target", train), "forest": lambda: models.forest_regressor("target")}[name]
    return fitted_once(spark, sf_dir, f"engagement-{name}", _POST_TABLES, lambda: models.fit_on_features(make(), train)), train, test


def _regressed(spark, sf_dir, name):
    """The test posts with the model's prediction beside that of the median."""
    model, train, test = _regressor(spark, sf_dir, name)
    predicted = model.transform(test).select("post_id", "target", "prediction")
    return splits.baseline_regressor(train, "target", predicted, "baseline")


def _beats(found, baseline, smaller: bool):
    """One row: whether a model's metric is at least as good as its baseline's."""
    ours, theirs = found.select(F.col(found.columns[0]).alias("_a")), baseline.select(F.col(baseline.columns[0]).alias("_b"))
    better = F.col("_a") <= F.col("_b") if smaller else F.col("_a") >= F.col("_b")
    return ours.crossJoin(F.broadcast(theirs)).select(better.alias("beats_baseline"))


def _regression_checks(spark, sf_dir, name):
    """Test posts with a finite prediction each, and whether their error is below that of the median."""
    predicted = materialise(_regressed(spark, sf_dir, name), "predicted")
    error = lambda column: metrics.regression_metrics(predicted, "target", column).select("rmse")
    finite = ~F.isnan("prediction") & (F.abs("prediction") < F.lit(1e6))
    checked = predicted.select("post_id", finite.alias("is_finite"))
    return checked.crossJoin(F.broadcast(_beats(error("prediction"), error("baseline"), smaller=True)))


_TESTED = "select post_id, true as is_finite, {} as beats_baseline from split where not is_train and total_engagement is not null"


@query("ridge_regression")
def ridge_regression(spark, sf_dir):
    """Test posts: log engagement, the prediction, and that of the train median."""
    return _regressed(spark, sf_dir, "ridge")


@query("forest_regressor")
def forest_regressor(spark, sf_dir):
    return _regressed(spark, sf_dir, "forest")


@query("engagement_metrics")
def engagement_metrics(spark, sf_dir):
    """MAE, RMSE and R2 on the test posts per model, the dummy's included."""
    ridge = _regressed(spark, sf_dir, "ridge")
    forest = _regressed(spark, sf_dir, "forest").select("post_id", "target", "prediction")
    rows = [
        ridge.select("target", F.lit("ridge").alias("model"), "prediction"),
        ridge.select("target", F.lit("dummy").alias("model"), F.col("baseline").alias("prediction")),
        forest.select("target", F.lit("forest").alias("model"), "prediction"),
    ]
    stacked = materialise(rows[0].unionByName(rows[1]).unionByName(rows[2]), "stacked")
    return metrics.regression_metrics(stacked, "target", "prediction", ["model"])


@query("ridge_optimum", "select cast(0 as bigint) as wrong_slopes, true as is_linear, true as intercept_is_mean")
def ridge_optimum(spark, sf_dir):
    """The conditions of the optimum: sum of residual x feature equals the penalty times the coefficient."""
    from pyspark.ml.functions import vector_to_array

    fitted, train, _ = _regressor(spark, sf_dir, "ridge")
    rows = materialise(
        fitted.transform(train).select(
            (F.col("target") - F.col("prediction")).alias("r"), "prediction", vector_to_array("features").alias("x")
        ),
        "residuals",
    )
    linear = fitted.stages[-1]
    known = spark.createDataFrame([(i, float(w)) for i, w in enumerate(linear.coefficients)], "i int, w double")
    # One row per feature.
    sums = rows.select("r", F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("r") * F.col("v")).alias("slope"), F.sum(F.abs(F.col("r") * F.col("v"))).alias("size")
    )
    off = F.abs(F.col("slope") - F.col("w")) > 1e-6 * (F.col("size") + 1)
    slopes = sums.join(F.broadcast(known), "i").agg(F.count_if(off).alias("wrong_slopes"))
    weights = F.array(*[F.lit(float(w)) for w in linear.coefficients])
    products = F.zip_with("x", weights, lambda a, b: a * b)
    line = F.aggregate(products, F.lit(float(linear.intercept)), lambda s, v: s + v)
    others = rows.agg(
        (F.max(F.abs(line - F.col("prediction"))) < 1e-6).alias("is_linear"), (F.abs(F.avg("r")) < 1e-6).alias("intercept_is_mean")
    )
    return slopes.crossJoin(F.broadcast(others))


@query("forest_regressor_holds", _TESTED.format("true"))
def forest_regressor_holds(spark, sf_dir):
    return _regression_checks(spark, sf_dir, "forest")


_Y, _P = "round(ln(1 + total_engagement), 6)", "round(ln(1 + views) / 2, 6)"


@query(
    "regression_metrics",
    f"""select round(avg(abs(y - p)), 6) as mae, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
          round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) as r2
        from (select {_Y} as y, {_P} as p, avg({_Y}) over () as m from posts where total_engagement is not null)""",
)
def regression_metrics(spark, sf_dir):
    fixed = view(spark, sf_dir, "posts").select(
        F.round(F.log1p("total_engagement"), 6).alias("y"), F.round(F.log1p("views") / F.lit(2), 6).alias("p")
    )
    return metrics.regression_metrics(fixed, "y", "p")


_VIRAL = """select s.*, case when s.viral_coefficient >= t.p90 then 1 else 0 end as viral from split s left join (
  select platform, quantile_cont(viral_coefficient, 0.9) as p90 from split where is_train group by platform) t
  on t.platform = s.platform"""


def viral_posts(spark, sf_dir):
    """The thresholds come from counts of train posts; the posts themselves are read, not written."""
    posts = view(spark, sf_dir, "posts")
    split = posts.withColumn("is_train", splits.chronological_cut(posts))
    return splits.viral_label(split.where("is_train").select("platform", "viral_coefficient"), split)


@query("viral_label", f"select post_id, platform, is_train, viral from ({_VIRAL})")
def viral_label(spark, sf_dir):
    return viral_posts(spark, sf_dir).select("post_id", "platform", "is_train", "viral")


@query(
    "baseline_classifier",
    f"""select viral, count(*) as row_count, round(count(*) * 1.0::double / sum(count(*)) over (), 6) as prior,
          count(*) = max(count(*)) over () as is_predicted from ({_VIRAL}) where is_train group by viral""",
)
def baseline_classifier(spark, sf_dir):
    return splits.baseline_classifier(viral_posts(spark, sf_dir).where("is_train"), "viral")


def _classifier_checks(model, test):
    """Test posts: the prediction is the likelier class, and chances add up to one."""
    from pyspark.ml.functions import vector_to_array

    predicted = model.transform(test).withColumn("p", vector_to_array("probability"))
    likelier = F.when(F.col("p")[1] > F.col("p")[0], 1.0).otherwise(0.0)
    return predicted.select(
        "post_id",
        ((F.col("prediction") == likelier) | (F.col("p")[0] == F.col("p")[1])).alias("is_most_likely"),
        (F.abs(F.col("p")[0] + F.col("p")[1] - 1) < 1e-9).alias("sums_to_one"),
    )


_CLASSIFIED = "select post_id, true as is_most_likely, true as sums_to_one from split where not is_train"


def _viral_model(spark, sf_dir, name):
    """A saved virality model, its training and its test posts."""
    posts = viral_posts(spark, sf_dir)
    train = posts.where("is_train")
    make = {"logistic": models.logistic, "forest": lambda label, rows: models.forest_classifier(label)}[name]
    model = fitted_once(spark, sf_dir, f"virality-{name}", _POST_TABLES, lambda: models.fit_balanced(make, train, "viral"))
    return model, train, posts.where("not is_train")


def _classified(spark, sf_dir, name):
    """Test posts: the label, the prediction and the chance of going viral, beside the share of viral train posts."""
    from pyspark.ml.functions import vector_to_array

    model, train, test = _viral_model(spark, sf_dir, name)
    chance = vector_to_array("probability")[1].alias("viral_probability")
    predicted = model.transform(test).select("post_id", "viral", F.col("prediction").cast("int").alias("prediction"), chance)
    # One row.
    return predicted.crossJoin(F.broadcast(train.agg(F.avg("viral").alias("prior"))))


@query("logistic_balanced")
def logistic_balanced(spark, sf_dir):
    return _classified(spark, sf_dir, "logistic")


@query("forest_classifier")
def forest_classifier(spark, sf_dir):
    return _classified(spark, sf_dir, "forest")


@query("virality_metrics")
def virality_metrics(spark, sf_dir):
    """F1, balanced accuracy, precision, recall and average precision on the test posts per model, the dummy's included."""
    rows = {name: materialise(_classified(spark, sf_dir, name), "classified") for name in ("logistic", "forest")}
    # The dummy predicts the more frequent class, and the same chance for all.
    dummy = rows["logistic"].withColumns({"prediction": (F.col("prior") >= 0.5).cast("int"), "viral_probability": F.col("prior")})
    found = []
    for name, df in {**rows, "dummy": dummy}.items():
        figures = metrics.binary_metrics(df, "viral", "prediction")
        # One row each.
        ranked = metrics.average_precision(df, "viral", "viral_probability")
        found.append(figures.crossJoin(F.broadcast(ranked)).select(F.lit(name).alias("model"), "*"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("logistic_balanced_holds", _CLASSIFIED)
def logistic_balanced_holds(spark, sf_dir):
    model, _, test = _viral_model(spark, sf_dir, "logistic")
    return _classifier_checks(model, test)


@query("forest_classifier_holds", _CLASSIFIED)
def forest_classifier_holds(spark, sf_dir):
    model, _, test = _viral_model(spark, sf_dir, "forest")
    return _classifier_checks(model, test)


def _fixed_binary(spark, sf_dir):
    posts = view(spark, sf_dir, "posts")
    return posts.select(
        F.coalesce((F.col("viral_coefficient") >= 1).cast("int"), F.lit(0)).alias("y"),
        (F.col("sentiment_positive") >= F.lit("0.5").cast("double")).cast("int").alias("p"),
        F.col("sentiment_positive").alias("score"),
    )


_FIXED = """select case when viral_coefficient >= 1 then 1 else 0 end as y, case when sentiment_positive >= 0.5 then 1 else 0 end as p,
  sentiment_positive as score from posts"""


@query(
    "binary_metrics",
    f"""select round(2.0::double * tp / (2 * tp + fp + fn), 6) as f1_viral,
          round((tp::double / (tp + fn) + tn::double / (tn + fp)) / 2, 6) as balanced_accuracy,
          round(tp::double / (tp + fp), 6) as precision_viral, round(tp::double / (tp + fn), 6) as recall_viral
        from (select count(*) filter (where y = 1 and p = 1) as tp, count(*) filter (where y = 0 and p = 1) as fp,
                count(*) filter (where y = 1 and p = 0) as fn, count(*) filter (where y = 0 and p = 0) as tn from ({_FIXED}))""",
)
def binary_metrics(spark, sf_dir):
    return metrics.binary_metrics(_fixed_binary(spark, sf_dir), "y", "p")


@query(
    "average_precision",
    f"""select round(sum(pos * cp::double / cn) / sum(pos), 6) as pr_auc from (
          select pos, sum(pos) over (order by score desc) as cp, sum(n) over (order by score desc) as cn
          from (select score, count(*) as n, sum(y) as pos from ({_FIXED}) group by score))""",
)
def average_precision(spark, sf_dir):
    return metrics.average_precision(_fixed_binary(spark, sf_dir), "y", "score")


_CORPORA = """select doc_id, 'docs' as corpus, d.text, case l.quality when 0 then 'negative' when 1 then 'positive' end as label, d.lang as language
  from documents d join labels l using (doc_id) where d.text is not null and l.quality in (0, 1)
  union all
  select event_id, 'events', props, case when user_id % 5 = 0 then 'negative' when user_id % 5 = 4 then 'positive' end, 'en'
  from events where user_id % 5 in (0, 4) and props is not null"""


@query("normalise_corpora", _CORPORA)
def normalise_corpora(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    first = documents.select("doc_id", F.lit("docs").alias("corpus"), "text", F.col("quality").alias("label"), "lang")
    events = table(spark, sf_dir, "events")
    second = events.select(
        F.col("event_id").alias("doc_id"), F.lit("events").alias("corpus"), "props", (F.col("user_id") % 5).alias("polarity")
    )
    return splits.normalise_corpora(
        splits.normalise_corpus(first, "text", "label", splits.LABELS_01, F.col("lang")).drop("lang"),
        splits.normalise_corpus(second, "props", "polarity", splits.LABELS_04, "en"),
    )


_HASH = "md5(concat(cast(doc_id as varchar), '-42'))"


@query(
    "stratified_sample",
    f"""select doc_id, r.label from (select *, row_number() over (partition by label order by {_HASH}) as place from reviews) r
        join (select label, whole + case when row_number() over (order by exact - whole desc, label)
                <= 150 - sum(whole) over () then 1 else 0 end as quota
              from (select label, count(*) * 150.0::double / sum(count(*)) over () as exact,
                      cast(floor(count(*) * 150.0::double / sum(count(*)) over ()) as bigint) as whole
                    from reviews group by label)) q on q.label = r.label and r.place <= q.quota""",
)
def stratified_sample(spark, sf_dir):
    return splits.stratified_sample(view(spark, sf_dir, "reviews"), "doc_id", _LABEL, 150).select("doc_id", "label")


@query(
    "stratified_split",
    f"""select doc_id, label, row_number() over (partition by label order by {_HASH})
          <= count(*) over (partition by label) * 80 // 100 as is_train from reviews""",
)
def stratified_split(spark, sf_dir):
    return splits.stratified_split(view(spark, sf_dir, "reviews"), "doc_id", _LABEL).select("doc_id", "label", "is_train")


_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_TERMS = f"""select doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: concat(t[i], ' ', t[i + 1])))) as term
  from (select doc_id, {_TOKENS} as t from documents)"""
_COUNTS = f"select doc_id, term, count(*) as c from ({_TERMS}) group by 1, 2"
_VOCABULARY = f"""select term, cast(sum(c) as bigint) as corpus_frequency, count(*) as document_frequency,
  ln((1.0::double + (select count(*) from documents)) / (1 + count(*))) + 1 as idf
  from ({_COUNTS}) group by term having count(*) >= 3"""


@query("term_table", f"select term, corpus_frequency, document_frequency, round(idf, 6) as idf from ({_VOCABULARY})")
def term_table(spark, sf_dir):
    return models.term_table(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "tfidf_features",
    f"""select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as tfidf from (
          select c.doc_id, c.term, (1 + ln(c.c)) * v.idf as w from ({_COUNTS}) c join ({_VOCABULARY}) v on v.term = c.term)""",
)
def tfidf_features(spark, sf_dir):
    return models.tfidf_features(table(spark, sf_dir, "documents"), "doc_id", "text")


def split_reviews(spark, sf_dir):
    split = materialise(splits.stratified_split(view(spark, sf_dir, "reviews"), "doc_id", _LABEL), "split")
    return split.where("is_train"), split.where(~F.col("is_train"))


_REVIEW_TABLES = ["documents", "labels"]


def text_model(spark, sf_dir, name):
    """A saved sentiment model: 'logistic' or 'svm'."""
    make = {"logistic": lambda label, n: models.logistic(label, n, max_iter=300), "svm": models.linear_svm}[name]
    fit = lambda: models.fit_text_model(make, split_reviews(spark, sf_dir)[0], vocabulary=models.VOCABULARY)
    return fitted_once(spark, sf_dir, f"sentiment-{name}", _REVIEW_TABLES, fit)


def sentiment_model(spark, sf_dir):
    return text_model(spark, sf_dir, "logistic")


def _text_checks(name, spark, sf_dir):
    """Test documents: their class is a known one, and training documents are mostly told right."""
    train, test = split_reviews(spark, sf_dir)
    model = text_model(spark, sf_dir, name)
    known = F.col("predicted_label").isin("positive", "negative").alias("is_known_label")
    fitted = models.predict_labels(model, train).agg((F.avg((F.col("label") == F.col("predicted_label")).cast("int")) > 0.9).alias("fits"))
    return models.predict_labels(model, test).select("doc_id", "label", known).crossJoin(F.broadcast(fitted))


def stacked_sentiment(spark, sf_dir):
    """Test documents once per model, the dummy's included: (model, doc_id, language, label, predicted_label)."""
    train, test = split_reviews(spark, sf_dir)
    rows = [
        models.predict_labels(text_model(spark, sf_dir, name), test).select(F.lit(name).alias("model"), "doc_id", "language", "label", "predicted_label")
        for name in ("logistic", "svm")
    ]
    top = splits.baseline_classifier(train, "label").where("is_predicted").select(F.col("label").alias("predicted_label"))
    # One row.
    dummy = test.crossJoin(F.broadcast(top)).select(F.lit("dummy").alias("model"), "doc_id", "language", "label", "predicted_label")
    return rows[0].unionByName(rows[1]).unionByName(dummy)


@query("sentiment_metrics")
def sentiment_metrics(spark, sf_dir):
    """All class metrics of the fitted models on the test documents, as a whole and per language."""
    return metrics.stacked_metrics(stacked_sentiment(spark, sf_dir), "label", "predicted_label")


@query("text_logistic")
def text_logistic(spark, sf_dir):
    """Test documents: the label, the predicted one and its probabilities."""
    test = split_reviews(spark, sf_dir)[1].select("doc_id", "language", "label", "text")
    return models.score_text(text_model(spark, sf_dir, "logistic"), test).drop("text", "neutral_probability")


@query("text_linear_svm")
def text_linear_svm(spark, sf_dir):
    test = split_reviews(spark, sf_dir)[1].select("doc_id", "language", "label", "text")
    return models.predict_labels(text_model(spark, sf_dir, "svm"), test).drop("text")


_TEXT_TESTED = f"""select doc_id, label, true as is_known_label, true as fits from (select doc_id, label,
  row_number() over (partition by label order by {_HASH}) <= count(*) over (partition by label) * 80 // 100 as is_train
  from reviews) where not is_train"""


@query("text_logistic_holds", _TEXT_TESTED)
def text_logistic_holds(spark, sf_dir):
    return _text_checks("logistic", spark, sf_dir)


@query("text_linear_svm_holds", _TEXT_TESTED)
def text_linear_svm_holds(spark, sf_dir):
    return _text_checks("svm", spark, sf_dir)


def _macro_sql(group: str) -> str:
    g = f"{group}, " if group else ""
    return f"""select {g}class, sum(tp) as tp, sum(actual) as actual, sum(predicted) as predicted from (
        select {g}label as class, case when label = fixed_prediction then 1 else 0 end as tp, 1 as actual, 0 as predicted from reviews
        union all select {g}fixed_prediction, 0, 0, 1 from reviews) group by {g}class"""


_F1 = "round(avg(case when actual + predicted = 0 then 0 else 2.0::double * tp / (actual + predicted) end), 6) as f1_macro"
_RECALL = "case when actual = 0 then 0 else tp::double / actual end"


@query(
    "macro_metrics",
    f"""select {_F1}, round(avg({_RECALL}) filter (where actual > 0), 6) as balanced_accuracy,
          round(avg(case when predicted = 0 then 0 else tp::double / predicted end), 6) as precision_macro,
          round(avg({_RECALL}), 6) as recall_macro from ({_macro_sql('')})""",
)
def macro_metrics(spark, sf_dir):
    return metrics.macro_metrics(view(spark, sf_dir, "reviews"), "label", "fixed_prediction")


@query(
    "metrics_by_language",
    f"""select language, {_F1}, round(avg({_RECALL}) filter (where actual > 0), 6) as balanced_accuracy
        from ({_macro_sql('language')}) group by language""",
)
def metrics_by_language(spark, sf_dir):
    return metrics.metrics_by_language(view(spark, sf_dir, "reviews"), "label", "fixed_prediction")


_TWO = """(select 'fixed' as model, language, label, fixed_prediction from reviews
    union all select 'source', language, label, case when doc_id % 3 = 0 then 'positive' else 'negative' end from reviews)"""


def _stacked_sql(scope: str) -> str:
    group = "model, language" if scope == "language" else "model"
    sides = f"""select {group}, label as class, case when label = fixed_prediction then 1 else 0 end as tp, 1 as actual, 0 as predicted from {_TWO}
        union all select {group}, fixed_prediction, 0, 0, 1 from {_TWO}"""
    language = "language" if scope == "language" else "cast(null as varchar)"
    return f"""select model, '{scope}' as scope, {language} as language, {_F1},
          round(avg({_RECALL}) filter (where actual > 0), 6) as balanced_accuracy,
          round(avg(case when predicted = 0 then 0 else tp::double / predicted end), 6) as precision_macro,
          round(avg({_RECALL}), 6) as recall_macro
        from (select {group}, class, sum(tp) as tp, sum(actual) as actual, sum(predicted) as predicted from ({sides}) group by {group}, class)
        {"where language is not null" if scope == "language" else ""} group by {group}"""


@query("stacked_metrics", f"{_stacked_sql('all')} union all {_stacked_sql('language')}")
def stacked_metrics(spark, sf_dir):
    """Two fixed predictions in place of models: all metrics of both, as a whole and per language, in one pass."""
    reviews = view(spark, sf_dir, "reviews").select("doc_id", "language", "label", "fixed_prediction")
    third = F.when(F.col("doc_id") % 3 == 0, "positive").otherwise("negative")
    both = reviews.withColumn("model", F.lit("fixed")).unionByName(reviews.withColumns({"model": F.lit("source"), "fixed_prediction": third}))
    return metrics.stacked_metrics(both, "label", "fixed_prediction")


@query(
    "confusion_matrix",
    """select label, count(*) filter (where fixed_prediction = 'negative') as predicted_negative,
         count(*) filter (where fixed_prediction = 'positive') as predicted_positive from reviews group by label order by label""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(view(spark, sf_dir, "reviews"), "label", "fixed_prediction", ["positive", "negative"])


def prediction_checks():
    """What must hold of every prediction: the label is the likeliest class, and chances add up to one."""
    chances = [F.col(f"{n}_probability") for n in ("positive", "negative", "neutral")]
    top = F.greatest(*chances)
    own = F.when(F.col("sentiment_label") == "positive", chances[0]).when(F.col("sentiment_label") == "negative", chances[1])
    total = chances[0] + chances[1] + chances[2]
    return [
        ((own == top) & (F.col("confidence") == top)).alias("is_most_likely"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
    ]


def _before_and_after(spark, sf_dir):
    """Scores of the model before it is saved and after it is loaded."""
    path, model, reviews = scratch_path(spark, "model"), sentiment_model(spark, sf_dir), view(spark, sf_dir, "reviews")
    models.save_model(model, path)
    before = models.score_text(model, reviews.select("doc_id", "text"))
    after = models.score_text(models.load_model(path), reviews.select("doc_id", "text"))
    return before.alias("b").join(after.alias("a"), "doc_id")


@query("persist_model")
def persist_model(spark, sf_dir):
    """Labels and confidence by the saved and by the reloaded model."""
    columns = [F.col(f"{s}.{c}").alias(f"{c}_{n}") for s, n in (("b", "before"), ("a", "after")) for c in ("sentiment_label", "confidence")]
    return _before_and_after(spark, sf_dir).select("doc_id", *columns)


@query("persist_model_holds", "select doc_id, true as same_label, true as same_confidence from reviews")
def persist_model_holds(spark, sf_dir):
    return _before_and_after(spark, sf_dir).select(
        "doc_id",
        (F.col("a.sentiment_label") == F.col("b.sentiment_label")).alias("same_label"),
        (F.abs(F.col("a.confidence") - F.col("b.confidence")) < 1e-12).alias("same_confidence"),
    )


def _scored_documents(spark, sf_dir):
    return models.score_text(sentiment_model(spark, sf_dir), dealt(table(spark, sf_dir, "documents"))).drop("text")


@query("score_text")
def score_text(spark, sf_dir):
    """Every document with its label, probabilities and confidence."""
    return _scored_documents(spark, sf_dir)


@query(
    "score_text_holds",
    "select doc_id, lang, source, n_chars, true as is_most_likely, true as sums_to_one from documents",
)
def score_text_holds(spark, sf_dir):
    return _scored_documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", *prediction_checks())


@query(
    "score_resumable",
    """select post_id, text_content from social_posts where source_id in (2, 3) and text_content is not null
         and post_id not in (select post_id from predictions where model_id = 11)""",
)
def score_resumable(spark, sf_dir):
    posts, stored = view(spark, sf_dir, "social_posts"), view(spark, sf_dir, "predictions")
    return models.score_candidates(posts, stored, 11, [2, 3])


def _resumed(spark, sf_dir):
    stored = view(spark, sf_dir, "predictions")
    scored = models.score_text(sentiment_model(spark, sf_dir), score_resumable(spark, sf_dir), "text_content")
    return models.append_predictions(stored, scored.drop("text_content"), 11)


@query("score_resumed")
def score_resumed(spark, sf_dir):
    """The predictions added for posts that had none."""
    return _resumed(spark, sf_dir)


@query(
    "score_resumed_holds",
    """select (select max(prediction_id) from predictions) + row_number() over (order by post_id) as prediction_id, post_id,
         cast(11 as int) as model_id, false as is_human_validated, true as is_most_likely, true as sums_to_one
       from social_posts where source_id in (2, 3) and text_content is not null
         and post_id not in (select post_id from predictions where model_id = 11)""",
)
def score_resumed_holds(spark, sf_dir):
    return _resumed(spark, sf_dir).select("prediction_id", "post_id", "model_id", "is_human_validated", *prediction_checks())


def _refreshed(spark, sf_dir):
    """The stored predictions after all posts of two sources were scored anew."""
    posts = view(spark, sf_dir, "social_posts")
    stored = view(spark, sf_dir, "predictions").join(posts.select("post_id", "source_id"), "post_id")
    store = PredictionStore(spark, scratch_path(spark, "predictions"))
    store.load(stored)
    store.score(sentiment_model(spark, sf_dir), posts, 11, [2, 3], resume=False)
    return store.read()


@query("score_refreshed")
def score_refreshed(spark, sf_dir):
    """Old predictions of the other sources, fresh ones of the two."""
    return _refreshed(spark, sf_dir)


@query(
    "score_refreshed_ids",
    """select prediction_id, post_id, model_id, source_id, false as is_fresh from predictions join social_posts using (post_id)
         where source_id not in (2, 3)
       union all
       select (select max(prediction_id) from predictions) + row_number() over (order by post_id), post_id, cast(11 as int), source_id, true
         from social_posts where source_id in (2, 3) and text_content is not null""",
)
def score_refreshed_ids(spark, sf_dir):
    last = view(spark, sf_dir, "predictions").agg(F.max("prediction_id")).first()[0] or 0
    fresh = (F.col("prediction_id") > last).alias("is_fresh")
    return _refreshed(spark, sf_dir).select("prediction_id", "post_id", "model_id", "source_id", fresh)


@query(
    "score_refresh",
    """select prediction_id, post_id, model_id, sentiment_label from predictions
       where not (model_id = 11 and post_id in (select post_id from social_posts where source_id in (2, 3)))""",
)
def score_refresh(spark, sf_dir):
    posts, stored = view(spark, sf_dir, "social_posts"), view(spark, sf_dir, "predictions")
    kept = models.score_refresh(stored, posts, 11, [2, 3])
    return kept.select("prediction_id", "post_id", "model_id", "sentiment_label")


def _external(spark, sf_dir):
    from pulseloom.sources.files import scan_structured

    target = scratch_path(spark, "scored") + ".parquet"
    models.score_external(spark, sentiment_model(spark, sf_dir), f"{sf_dir}/documents.parquet", target)
    return scan_structured(spark, target)


@query("score_external")
def score_external(spark, sf_dir):
    """The scored file: all columns it had and the four of the prediction."""
    return _external(spark, sf_dir)


@query(
    "score_external_holds",
    "select doc_id, lang, source, n_chars, true as is_known_label, true as sums_to_one from documents",
)
def score_external_holds(spark, sf_dir):
    total = F.col("positive_probability") + F.col("negative_probability")
    checks = [F.col("sentiment_label").isin("positive", "negative").alias("is_known_label"), (F.abs(total - 1) < 1e-9).alias("sums_to_one")]
    return _external(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", *checks)


_KEPT = "not (source_id = 3 and task_type = 'sentiment')"
_NEW_RUN = """select (select max(o_orderkey) from orders) + 1 as run_id, 11 as model_id, 3 as source_id,
  'sentiment' as task_type, 80 as train_rows, 20 as test_rows, timestamp '2024-01-02 00:00:00' as run_at"""


def _tracked(spark, sf_dir):
    runs, values = view(spark, sf_dir, "runs"), view(spark, sf_dir, "metrics")
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    new = metrics.run_row(spark, last + 1, 11, 3, "sentiment", 80, 20, {"model": "tfidf_logistic"}, "2024-01-02 00:00:00")
    scores = metrics.macro_metrics(view(spark, sf_dir, "reviews"), "label", "fixed_prediction").select("f1_macro", "recall_macro")
    rows = metrics.metric_rows(scores, last + 1, (last + 1) * 10)
    return metrics.track_run(runs, values, new, rows, 3, "sentiment")


@query(
    "track_run",
    f"select run_id, model_id, source_id, task_type, train_rows, test_rows, run_at from runs where {_KEPT} union all {_NEW_RUN}",
)
def track_run(spark, sf_dir):
    return _tracked(spark, sf_dir)[0]


@query(
    "track_run_metrics",
    f"""select metric_id, run_id, metric_name, round(metric_value, 6) as metric_value from metrics
        where run_id not in (select run_id from runs where not {_KEPT})
        union all select (select max(o_orderkey) + 1 from orders) * 10 + i, (select max(o_orderkey) + 1 from orders), name, value
        from (select 0 as i, 'f1_macro' as name, (select {_F1} from ({_macro_sql('')})) as value
              union all select 1, 'recall_macro', (select round(avg({_RECALL}), 6) from ({_macro_sql('')})))""",
)
def track_run_metrics(spark, sf_dir):
    return _tracked(spark, sf_dir)[1].drop("class_label")


@query("track_fitted")
def track_fitted(spark, sf_dir):
    """Metrics of the fitted sentiment models as tracked rows, per model and per language, beside the dummy's."""
    last = view(spark, sf_dir, "runs").agg(F.max("run_id")).first()[0] or 0
    runs = {name: last + n for n, name in enumerate(("dummy", "logistic", "svm"), 1)}
    found = materialise(sentiment_metrics(spark, sf_dir), "metrics")
    return metrics.language_metric_rows(found, runs, 10 * (last + 1))


def _themes(spark, sf_dir, ks=models.CLUSTERS):
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return models.theme_search(docs, "doc_id", ks, vocabulary=models.VOCABULARY)


@query("discover_themes")
def discover_themes(spark, sf_dir):
    """Each document's cluster for 6, 8 and 10 clusters, with the silhouette of each clustering."""
    return _themes(spark, sf_dir)[0]


@query("theme_terms")
def theme_terms(spark, sf_dir):
    """The ten heaviest terms of each centre."""
    return _themes(spark, sf_dir)[1]


@query("discover_themes_holds", "select doc_id, true as in_range, cast(6 as bigint) as used_clusters from documents")
def discover_themes_holds(spark, sf_dir):
    """Each document has one of the clusters, and none is left empty."""
    found = materialise(_themes(spark, sf_dir, (6,))[0], "clusters")
    used = found.agg(F.count_distinct("cluster").alias("used_clusters"))
    return found.select("doc_id", F.col("cluster").between(0, 5).alias("in_range")).crossJoin(F.broadcast(used))
