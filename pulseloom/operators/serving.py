"""Rules and read queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank

TOXICITY_ALERT = 50
MAX_PAGE = 500
POST_COLUMNS = [
    "post_id", "source_id", "platform_id", "external_post_id", "text_content", "published_at", "likes", "comments",
    "shares", "views",
]


def recommendations_build(kpis: DataFrame, as_of: Column) -> DataFrame:
    """One explained recommendation per platform, numbered by platform name."""
    evidence = F.to_json(F.struct("post_count", "median_engagement", "average_engagement_rate"))
    rows = kpis.select(
        "platform_name",
        F.lit("format_engagement").alias("recommendation_type"),
        F.format_string("Prioriser les contenus performants sur %s.", F.col("platform_name")).alias("recommendation_text"),
        evidence.alias("evidence"),
        F.col("average_engagement_rate").alias("score"),
        as_of.cast("timestamp_ntz").alias("generated_at"),
    )
    return global_rank(rows, [F.col("platform_name")], "recommendation_id")


def alerts_build(kpis: DataFrame, as_of: Column, threshold: float = TOXICITY_ALERT) -> DataFrame:
    """A HIGH alert per platform whose mean toxicity reaches the threshold; none for NULL."""
    rows = kpis.where(F.col("average_toxicity") >= threshold).select(
        "platform_name",
        F.lit("high_toxicity").alias("alert_type"),
        F.format_string("Surveiller la toxicite moyenne sur %s.", F.col("platform_name")).alias("alert_text"),
        F.lit("HIGH").alias("severity"),
        F.to_json(F.struct("average_toxicity")).alias("evidence"),
        as_of.cast("timestamp_ntz").alias("generated_at"),
    )
    return global_rank(rows, [F.col("platform_name")], "alert_id")


def recommendations_ranked(recommendations: DataFrame) -> DataFrame:
    return recommendations.orderBy(F.col("score").desc(), "recommendation_id")


def alerts_recent(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.col("generated_at").desc(), "alert_id")


def posts_page(
    posts: DataFrame,
    source_id: int | None = None,
    platform_id: int | None = None,
    limit: int = 50,
    offset: int = 0,
    after_post_id: int | None = None,
) -> DataFrame:
    """A page of all post versions in id order.

    ``after_post_id`` continues from the last id of the previous page; unlike a
    deep offset it is a pushed-down filter.
    """
    if not 0 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be 0 to {MAX_PAGE} and offset at least 0")
    rows = posts
    if source_id is not None:
        rows = rows.where(F.col("source_id") == source_id)
    if platform_id is not None:
        rows = rows.where(F.col("platform_id") == platform_id)
    if after_post_id is not None:
        rows = rows.where(F.col("post_id") > after_post_id)
    return rows.select(*POST_COLUMNS).orderBy("post_id").offset(offset).limit(limit)


def post_lookup(posts: DataFrame, post_id: int) -> DataFrame:
    return posts.where(F.col("post_id") == post_id).select(*POST_COLUMNS)


def posts_scoped(posts: DataFrame, role: str, scope_source_id: int | None, limit: int | None = 50) -> DataFrame:
    """All rows for the institution administrator, else only the own source."""
    rows = posts if role == "institution_admin" else posts.where(F.col("source_id") == F.lit(scope_source_id))
    rows = rows.select(*POST_COLUMNS).orderBy("post_id")
    return rows if limit is None else rows.limit(limit)


def post_predictions(predictions: DataFrame, post_id: int) -> DataFrame:
    return predictions.where(F.col("post_id") == post_id).drop("is_human_validated")


def sentiment_summary(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("count")).orderBy("sentiment_label")


def list_sources(sources: DataFrame) -> DataFrame:
    return sources.select("source_id", "source_name", "provenance", "language").orderBy("source_id")


def list_platforms(platforms: DataFrame) -> DataFrame:
    return platforms.select("platform_id", "platform_name", "content_type").orderBy("platform_id")


def model_runs_joined(runs: DataFrame, models: DataFrame, sources: DataFrame) -> DataFrame:
    """Runs with the names of their model and source. Catalyst sizes the two dimensions."""
    return (
        runs.join(models.select("model_id", "model_name"), "model_id")
        .join(sources.select("source_id", "source_name"), "source_id")
        .select("run_id", "model_name", "source_name", "task_type", "train_rows", "test_rows", "run_at")
        .orderBy("run_id")
    )


def run_metrics(runs: DataFrame, metrics: DataFrame, run_id: int) -> DataFrame:
    """Metrics of one run; an unknown run is an error."""
    if runs.where(F.col("run_id") == run_id).limit(1).count() == 0:
        raise LookupError(f"run {run_id} is not known")
    columns = ["metric_id", "run_id", "metric_name", "metric_value", "class_label"]
    return metrics.where(F.col("run_id") == run_id).select(*columns)


def metrics_pivot(runs: DataFrame, metrics: DataFrame, names: list[str], required: str | None = None) -> DataFrame:
    """One row per run, a column per metric name; ``required`` keeps runs that have it.

    Several values of one name: the one with the largest metric id counts.
    """
    columns = [F.max_by(F.when(F.col("metric_name") == n, F.col("metric_value")), F.when(F.col("metric_name") == n, F.col("metric_id"))).alias(n) for n in names]
    wide = runs.select("run_id").join(metrics.groupBy("run_id").agg(*columns), "run_id", "left")
    return wide if required is None else wide.where(F.col(required).isNotNull())


def run_status(events: DataFrame) -> DataFrame:
    """Fold start and end events into one row per run.

    RUNNING until an end event; then SUCCESS with totals, or FAILED with
    ``Type: message`` and no totals.
    """
    ended = F.max_by(
        F.struct("ts", "error_type", "error_message", "sources", "new_rows", "updated_rows"),
        F.when(F.col("event") == "end", F.col("ts")),
    )
    folded = events.groupBy("run_id").agg(
        F.min(F.when(F.col("event") == "start", F.col("ts"))).alias("started_at"),
        F.max(F.when(F.col("event") == "start", F.col("trigger_type"))).alias("trigger_type"),
        F.count_if(F.col("event") == "end").alias("_ends"),
        ended.alias("_end"),
    )
    over = F.col("_ends") > 0
    failed = over & F.col("_end.error_type").isNotNull()
    success = over & ~failed
    return folded.select(
        "run_id",
        "trigger_type",
        "started_at",
        F.when(over, F.col("_end.ts")).alias("finished_at"),
        F.when(failed, "FAILED").when(over, "SUCCESS").otherwise("RUNNING").alias("status"),
        F.when(success, F.col("_end.sources")).alias("sources_processed"),
        F.when(success, F.col("_end.new_rows")).alias("total_new_rows"),
        F.when(success, F.col("_end.updated_rows")).alias("total_updated_rows"),
        F.when(failed, F.concat_ws(": ", "_end.error_type", "_end.error_message")).alias("error_message"),
    )


def run_history(runs: DataFrame, limit: int | None = 10) -> DataFrame:
    """Newest runs first with their duration in seconds; unfinished totals read 0."""
    start, end = F.col("started_at").cast("timestamp"), F.col("finished_at").cast("timestamp")
    rows = runs.select(
        "run_id",
        "trigger_type",
        "status",
        "started_at",
        ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)).alias("duration_seconds"),
        F.coalesce("total_new_rows", F.lit(0)).alias("total_new_rows"),
        F.coalesce("total_updated_rows", F.lit(0)).alias("total_updated_rows"),
        "error_message",
    ).orderBy(F.col("run_id").desc())
    return rows if limit is None else rows.limit(limit)
