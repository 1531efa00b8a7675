"""Descriptive KPIs of the main corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.ordering import global_rank
from pulseloom.functions.quantiles import Measure, mean, rows, rows_where, summarise

MAIN_SOURCE = 8
POST_COLUMNS = [
    "published_at", "followers", "topic", "language", "media_type", "num_hashtags", "sentiment_category",
    "sentiment_positive", "sentiment_negative", "sentiment_neutral", "likes", "shares", "comments", "views",
    "total_engagement", "engagement_rate_per_1k_followers", "viral_coefficient", "cross_platform_spread",
    "toxicity_score",
]


def build_post_fact(posts: DataFrame) -> DataFrame:
    """The analytic post table, keyed in order of the post id."""
    shaped = posts.select(
        F.lit(MAIN_SOURCE).alias("source_id"),
        F.col("post_id").alias("external_post_id"),
        F.col("platform").alias("platform_name"),
        *POST_COLUMNS,
    )
    return global_rank(shaped, [F.col("external_post_id")], "analytics_id")


def _measures() -> list[Measure]:
    return [
        rows("post_count"),
        mean("total_engagement", "average_engagement"),
        mean("engagement_rate_per_1k_followers", "average_engagement_rate"),
        rows_where(F.col("viral_coefficient") >= 1, "viral_post_count"),
        mean("toxicity_score", "average_toxicity"),
    ]


def kpi_platform(posts: DataFrame, **options) -> DataFrame:
    named = posts.withColumnRenamed("platform", "platform_name")
    median = {"median_engagement": 0.5}
    return summarise(named, ["platform_name"], "total_engagement", median, _measures(), **options)


def kpi_daily(posts: DataFrame) -> DataFrame:
    return posts.groupBy(F.col("published_at").cast("date").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("total_engagement").alias("total_engagement"),
        F.avg("viral_coefficient").alias("average_viral_coefficient"),
        F.avg("toxicity_score").alias("average_toxicity"),
    )


def hashtag_bucket(n: Column) -> Column:
    """0, 1-2, 3-5; everything else, NULL included, is 6+."""
    return F.when(n == 0, "0").when(n.between(1, 2), "1-2").when(n.between(3, 5), "3-5").otherwise("6+")


def segment_rows(posts: DataFrame) -> DataFrame:
    """Each post once per dimension: one scan where a union would take five."""
    dimensions = {
        "topic": F.coalesce("topic", F.lit("unknown")),
        "media_type": F.coalesce("media_type", F.lit("unknown")),
        "language": F.coalesce("language", F.lit("unknown")),
        "sentiment": F.coalesce("sentiment_category", F.lit("unknown")),
        "hashtag_bucket": hashtag_bucket(F.col("num_hashtags")),
    }
    entries = [F.struct(F.lit(n).alias("dimension_name"), v.alias("dimension_value")) for n, v in dimensions.items()]
    measures = ["total_engagement", "engagement_rate_per_1k_followers", "viral_coefficient", "toxicity_score"]
    return posts.select(*measures, F.inline(F.array(*entries)))


def kpi_segment(posts: DataFrame, **options) -> DataFrame:
    """The same measures for five dimensions, numbered by dimension and value."""
    keys = ["dimension_name", "dimension_value"]
    median = {"median_engagement": 0.5}
    kpis = summarise(segment_rows(posts), keys, "total_engagement", median, _measures(), **options)
    return global_rank(kpis, [F.col(k) for k in keys], "segment_id")


def kpi_platform_ranked(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy(F.col("average_engagement").desc(), "platform_name")


def kpi_daily_series(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy("activity_date")


def kpi_segment_report(kpis: DataFrame) -> DataFrame:
    columns = [
        "dimension_name", "dimension_value", "post_count", "median_engagement", "average_engagement_rate",
        "average_toxicity",
    ]
    return kpis.select(*columns).orderBy("dimension_name", F.col("post_count").desc(), "dimension_value")
