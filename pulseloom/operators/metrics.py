"""Metrics of predictions, and run tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.functions.joins import null_safe_join
from pulseloom.functions.ordering import running_sums


def regression_metrics(df: DataFrame, target: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2. The total sum of squares uses the mean, found in a first pass."""
    group = group or []
    y, p = F.col(target), F.col(prediction)
    rows = df.where(y.isNotNull() & p.isNotNull())
    mean = rows.groupBy(*group).agg(F.avg(y).alias("_mean")) if group else rows.agg(F.avg(y).alias("_mean"))
    rows = null_safe_join(rows, mean, group)
    aggregates = [
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.lit(1) - F.try_divide(F.sum((y - p) * (y - p)), F.sum((y - F.col("_mean")) * (y - F.col("_mean"))))).alias("r2"),
    ]
    return rows.groupBy(*group).agg(*aggregates) if group else rows.agg(*aggregates)


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0).cast("double"))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """F1, balanced accuracy, precision and recall of class 1; 0 where undefined."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        _or_zero(tp * 2, tp * 2 + fp + fn).alias("f1_viral"),
        ((_or_zero(tp, tp + fn) + _or_zero(tn, tn + fp)) / F.lit(2)).alias("balanced_accuracy"),
        _or_zero(tp, tp + fp).alias("precision_viral"),
        _or_zero(tp, tp + fn).alias("recall_viral"),
    )


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Step-sum average precision with equal scores taken together.

    Rows shrink to one per score before the global running sum.
    """
    by_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_pos"))
    )
    summed = running_sums(by_score, [F.col(score).desc()], {"_cum_n": "_n", "_cum_pos": "_pos"})
    gain = F.sum(F.col("_pos") * F.col("_cum_pos") / F.col("_cum_n"))
    return summed.agg(F.coalesce(F.try_divide(gain, F.sum("_pos")), F.lit(0).cast("double")).alias("pr_auc"))


def confusion_counts(df: DataFrame, label: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    """(group..., label, prediction, n): everything the class metrics need."""
    return df.groupBy(*(group or []), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _per_class(counts: DataFrame, group: list[str]) -> DataFrame:
    """Hits, true rows and predicted rows per class."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted")),
    )
    rows = counts.select(*group, F.inline(sides))
    return rows.groupBy(*group, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "predicted")])


def macro_metrics(df: DataFrame, label: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    """Macro F1, balanced accuracy, macro precision and recall.

    Balanced accuracy averages the recall of classes that occur in the labels.
    """
    group = group or []
    return _macro(_per_class(confusion_counts(df, label, prediction, group), group), group)


def _macro(per: DataFrame, group: list[str]) -> DataFrame:
    """Averages over the classes."""
    recall = _or_zero(F.col("tp"), F.col("actual"))
    precision = _or_zero(F.col("tp"), F.col("predicted"))
    f1 = _or_zero(F.col("tp") * 2, F.col("actual") + F.col("predicted"))
    return per.groupBy(*group).agg(
        F.avg(f1).alias("f1_macro"),
        F.avg(F.when(F.col("actual") > 0, recall)).alias("balanced_accuracy"),
        F.avg(precision).alias("precision_macro"),
        F.avg(recall).alias("recall_macro"),
    )


def metrics_by_language(df: DataFrame, label: str, prediction: str, language: str = "language") -> DataFrame:
    """Macro F1 and balanced accuracy per language present."""
    return macro_metrics(df, label, prediction, [language]).select(language, "f1_macro", "balanced_accuracy")


def stacked_metrics(df: DataFrame, label: str, prediction: str, model: str = "model", language: str = "language") -> DataFrame:
    """All class metrics of several models at once: per model, and per model and language.

    ``df`` has one row per model and document. One pass counts (model, language, label,
    prediction); grouping sets add the rows of a model as a whole, whose language is NULL
    and whose ``scope`` is 'all'. A NULL language is left out of the rows per language.
    """
    counts = confusion_counts(df, label, prediction, [model, language])
    sums = counts.groupingSets(
        [[model, "label", "prediction"], [model, language, "label", "prediction"]], model, language, "label", "prediction"
    ).agg(F.sum("n").alias("n"), F.grouping(language).alias("_whole"))
    scope = F.when(F.col("_whole") == 1, "all").otherwise("language").alias("scope")
    cells = sums.where((F.col("_whole") == 1) | F.col(language).isNotNull()).select(model, scope, language, "label", "prediction", "n")
    group = [model, "scope", language]
    per = _per_class(cells, group)
    return _macro(per, group)


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: list[str]) -> DataFrame:
    """One row per label, one column ``predicted_<label>`` each, in sorted order, 0 filled."""
    names = sorted(labels)
    columns = [F.count_if(F.col(prediction) == n).alias(f"predicted_{n}") for n in names]
    counts = df.where(F.col(label).isin(names)).groupBy(F.col(label).alias("label")).agg(*columns)
    rows = df.sparkSession.createDataFrame([(n,) for n in names], "label string")
    filled = [F.coalesce(f"predicted_{n}", F.lit(0)).alias(f"predicted_{n}") for n in names]
    return rows.join(counts, "label", "left").select("label", *filled).orderBy("label")


def track_run(
    runs: DataFrame, metrics: DataFrame, new_runs: DataFrame, new_metrics: DataFrame, source_id: int, task: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Replace the runs of a source (and task) and their metrics by new ones."""
    mine = F.col("source_id") == source_id
    if task is not None:
        mine = mine & (F.col("task_type") == task)
    stale = F.coalesce(mine, F.lit(False))
    kept_metrics = metrics.join(runs.where(stale).select("run_id"), "run_id", "left_anti").select(*metrics.columns)
    return (
        runs.where(~stale).unionByName(new_runs.select(*runs.columns)),
        kept_metrics.unionByName(new_metrics.select(*metrics.columns)),
    )


def run_row(spark, run_id: int, model_id: int, source_id: int, task: str, train: int, test: int, hyperparameters: dict, as_of) -> DataFrame:
    """One tracked run with its settings as JSON text."""
    names = [F.lit(v).alias(k) for k, v in hyperparameters.items()]
    return spark.range(1).select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(model_id).alias("model_id"),
        F.lit(source_id).alias("source_id"),
        F.lit(task).alias("task_type"),
        F.to_json(F.struct(*names)).alias("hyperparameters"),
        F.lit(train).alias("train_rows"),
        F.lit(test).alias("test_rows"),
        F.lit(42).alias("split_seed"),
        F.lit(as_of).cast("timestamp_ntz").alias("run_at"),
    )


def language_metric_rows(found: DataFrame, runs: dict[str, int], first_id: int = 1) -> DataFrame:
    """Metrics of ``stacked_metrics`` as rows of ``model_metric``: those of a language are named ``<metric>_<language>``.

    ``runs`` gives the run of each model; ids follow run and name. A handful of rows.
    """
    spark = found.sparkSession
    known = spark.createDataFrame(list(runs.items()), "model string, run_id long")
    names = ["f1_macro", "balanced_accuracy", "precision_macro", "recall_macro"]
    entries = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("metric_value")) for n in names]
    long = found.join(F.broadcast(known), "model").select("run_id", "scope", "language", F.inline(F.array(*entries)))
    # A language's rows have the two metrics that are compared between languages.
    wanted = (F.col("scope") == "all") | F.col("metric").isin("f1_macro", "balanced_accuracy")
    name = F.when(F.col("scope") == "all", F.col("metric")).otherwise(F.concat_ws("_", "metric", "language"))
    rows = long.where(wanted).select("run_id", name.alias("metric_name"), "metric_value", F.lit(None).cast("string").alias("class_label"))
    number = F.row_number().over(Window.orderBy("run_id", "metric_name"))
    return rows.withColumn("metric_id", (number + F.lit(first_id - 1)).cast("long"))


def metric_rows(metrics: DataFrame, run_id: int, first_id: int = 1) -> DataFrame:
    """One-row metric frame to (metric_id, run_id, metric_name, metric_value, class_label)."""
    entries = [
        F.struct(
            F.lit(first_id + i).cast("long").alias("metric_id"),
            F.lit(run_id).cast("long").alias("run_id"),
            F.lit(name).alias("metric_name"),
            F.col(name).cast("double").alias("metric_value"),
            F.lit(None).cast("string").alias("class_label"),
        )
        for i, name in enumerate(metrics.columns)
    ]
    return metrics.select(F.inline(F.array(*entries)))
