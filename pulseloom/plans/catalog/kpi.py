"""KPI queries."""

from __future__ import annotations

from pulseloom.operators import kpi
from pulseloom.plans.bindings import view
from pulseloom.plans.registry import query

_KPI = """platform_name, post_count, round(median_engagement, 6) as median_engagement,
  round(average_engagement, 6) as average_engagement, round(average_engagement_rate, 6) as average_engagement_rate,
  viral_post_count, round(average_toxicity, 6) as average_toxicity"""
_DAILY = """activity_date, post_count, total_engagement, round(average_viral_coefficient, 6) as average_viral_coefficient,
  round(average_toxicity, 6) as average_toxicity"""


@query(
    "build_post_fact",
    """select row_number() over (order by post_id) as analytics_id, 8 as source_id, post_id as external_post_id,
         platform as platform_name, published_at, followers, topic, language, media_type, num_hashtags,
         sentiment_category, round(sentiment_positive, 6) as sentiment_positive,
         round(sentiment_negative, 6) as sentiment_negative, round(sentiment_neutral, 6) as sentiment_neutral, likes,
         shares, comments, views, total_engagement,
         round(engagement_rate_per_1k_followers, 6) as engagement_rate_per_1k_followers,
         round(viral_coefficient, 6) as viral_coefficient, round(cross_platform_spread, 6) as cross_platform_spread,
         round(toxicity_score, 6) as toxicity_score from posts""",
)
def build_post_fact(spark, sf_dir):
    return kpi.build_post_fact(view(spark, sf_dir, "posts"))


@query("kpi_platform", f"select {_KPI} from kpis")
def kpi_platform(spark, sf_dir):
    return kpi.kpi_platform(view(spark, sf_dir, "posts"))


@query("kpi_daily", f"select {_DAILY} from daily")
def kpi_daily(spark, sf_dir):
    return kpi.kpi_daily(view(spark, sf_dir, "posts"))


@query(
    "kpi_segment",
    """select segment_id, dimension_name, dimension_value, post_count, round(median_engagement, 6) as median_engagement,
         round(average_engagement, 6) as average_engagement, round(average_engagement_rate, 6) as average_engagement_rate,
         viral_post_count, round(average_toxicity, 6) as average_toxicity from segments""",
)
def kpi_segment(spark, sf_dir):
    return kpi.kpi_segment(view(spark, sf_dir, "posts"))


@query(
    "hashtag_bucket",
    """select post_id, num_hashtags, case when num_hashtags = 0 then '0' when num_hashtags between 1 and 2 then '1-2'
         when num_hashtags between 3 and 5 then '3-5' else '6+' end as hashtag_bucket from posts""",
)
def hashtag_bucket(spark, sf_dir):
    posts = view(spark, sf_dir, "posts")
    return posts.select("post_id", "num_hashtags", kpi.hashtag_bucket(posts.num_hashtags).alias("hashtag_bucket"))


@query("kpi_platform_ranked", f"select {_KPI} from kpis order by average_engagement desc, platform_name")
def kpi_platform_ranked(spark, sf_dir):
    return kpi.kpi_platform_ranked(kpi_platform(spark, sf_dir))


@query("kpi_daily_series", f"select {_DAILY} from daily order by activity_date")
def kpi_daily_series(spark, sf_dir):
    return kpi.kpi_daily_series(kpi_daily(spark, sf_dir))


@query(
    "kpi_segment_report",
    """select dimension_name, dimension_value, post_count, round(median_engagement, 6) as median_engagement,
         round(average_engagement_rate, 6) as average_engagement_rate, round(average_toxicity, 6) as average_toxicity
       from segments order by dimension_name, post_count desc, dimension_value""",
)
def kpi_segment_report(spark, sf_dir):
    return kpi.kpi_segment_report(kpi_segment(spark, sf_dir))
