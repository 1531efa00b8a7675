"""Behaviour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.operators import behavior
from pulseloom.plans.bindings import view
from pulseloom.plans.catalog.themes import post_themes
from pulseloom.plans.registry import query
from pulseloom.session import materialise

_CONTEXT = """comment_id, external_post_id, author_pseudo, page_name, theme, media_type, language, commented_at,
  published_at, round(reaction_delay_hours, 6) as reaction_delay_hours, comment_hour, is_weekend, comment_length"""
_WITHIN = """round(100.0::double * count(*) filter (where reaction_delay_hours < 1) / count(*), 6) as pct_within_1h,
  round(100.0::double * count(*) filter (where reaction_delay_hours < 6) / count(*), 6) as pct_within_6h,
  round(median(reaction_delay_hours), 6) as median_delay_hours,
  round(quantile_cont(reaction_delay_hours, 0.9), 6) as p90_delay_hours,
  min(commented_at) as period_start, max(commented_at) as period_end"""
_SEGMENT_MEANS = """round(median(median_delay_hours), 6) as median_delay_hours,
  round(avg(avg_comment_length), 6) as avg_comment_length, round(avg(distinct_themes), 6) as avg_distinct_themes"""
_VOLUME = """segment, count(*) as author_count, round(100.0::double * count(*) / sum(count(*)) over (), 6) as author_share,
  cast(sum(comment_count) as bigint) as comment_count,
  round(100.0::double * sum(comment_count) / sum(sum(comment_count)) over (), 6) as comment_share"""
_ROLLUP = """theme, cast(sum(post_count) as bigint) as post_count, cast(sum(comment_count) as bigint) as comment_count,
  round(sum(comment_count) * 1.0::double / sum(post_count), 6) as comments_per_post,
  round(median(median_delay_hours), 6) as median_delay_hours, round(avg(avg_comment_length), 6) as avg_comment_length"""


def context(spark, sf_dir):
    return behavior.comment_context(view(spark, sf_dir, "comments"), post_themes(spark, sf_dir))


def context_table(spark, sf_dir):
    """The context as a written table, for queries that pass over it more than once."""
    return materialise(context(spark, sf_dir), "context")


def author_table(spark, sf_dir):
    return materialise(behavior.author_profile(context_table(spark, sf_dir)), "authors")


def reaction_table(spark, sf_dir):
    themes = materialise(post_themes(spark, sf_dir), "themes")
    context = materialise(behavior.comment_context(view(spark, sf_dir, "comments"), themes), "context")
    return materialise(behavior.theme_reaction(context, themes), "reaction")


@query("comment_context", f"select {_CONTEXT} from context")
def comment_context(spark, sf_dir):
    return context(spark, sf_dir)


@query(
    "reaction_delay",
    """select id_commentaire, round(date_diff('second', date_publication, date_commentaire) / 3600.0::double, 6)
         as reaction_delay_hours from comments""",
)
def reaction_delay(spark, sf_dir):
    return behavior.reaction_delay(view(spark, sf_dir, "comments")).select("id_commentaire", "reaction_delay_hours")


@query(
    "time_features",
    """select id_commentaire, cast(extract(hour from date_commentaire) as int) as comment_hour,
         extract(dow from date_commentaire) in (0, 6) as is_weekend from comments""",
)
def time_features(spark, sf_dir):
    return behavior.time_features(view(spark, sf_dir, "comments")).select("id_commentaire", "comment_hour", "is_weekend")


@query(
    "comment_length",
    """select id_commentaire, cast(length(coalesce(texte, '')) as int) as comment_length,
         cast(length(coalesce(texte_publication, '')) as int) as post_length from comments""",
)
def comment_length(spark, sf_dir):
    comments = behavior.comment_length(view(spark, sf_dir, "comments"))
    post = F.length(F.coalesce("texte_publication", F.lit(""))).alias("post_length")
    return comments.select("id_commentaire", "comment_length", post)


@query(
    "negative_delay_count",
    """select count(*) as comment_count, count(*) filter (where reaction_delay_hours < 0) as negative_count from context""",
)
def negative_delay_count(spark, sf_dir):
    return behavior.negative_delay_count(context(spark, sf_dir))


@query(
    "author_profile",
    """select author_pseudo, comment_count, segment, distinct_posts, distinct_themes, distinct_pages,
         round(median_delay_hours, 6) as median_delay_hours, round(avg_comment_length, 6) as avg_comment_length,
         first_seen_at, last_seen_at, active_days from authors""",
)
def author_profile(spark, sf_dir):
    return author_table(spark, sf_dir)


@query("author_segment", "select author_pseudo, comment_count, segment from authors")
def author_segment(spark, sf_dir):
    counts = behavior.valid_delay(context(spark, sf_dir)).where(F.col("author_pseudo").isNotNull())
    counts = counts.groupBy("author_pseudo").agg(F.count(F.lit(1)).alias("comment_count"))
    return counts.withColumn("segment", behavior.author_segment(F.col("comment_count")))


@query("segment_volume", f"select {_VOLUME} from authors group by segment")
def segment_volume(spark, sf_dir):
    return behavior.segment_volume(author_segment(spark, sf_dir))


@query(
    "theme_reaction",
    """select theme, page_name, post_count, comment_count, round(comments_per_post, 6) as comments_per_post,
         distinct_authors, round(median_delay_hours, 6) as median_delay_hours,
         round(avg_comment_length, 6) as avg_comment_length, round(median_post_likes, 6) as median_post_likes
       from reaction""",
)
def theme_reaction(spark, sf_dir):
    return reaction_table(spark, sf_dir)


@query(
    "behavior_overview",
    f"""select count(*) as comment_count, count(distinct external_post_id) as post_count,
          count(distinct author_pseudo) as author_count, count(distinct theme) as theme_count, {_WITHIN} from valid""",
)
def behavior_overview(spark, sf_dir):
    return behavior.behavior_overview(context_table(spark, sf_dir))


@query("segment_shares", f"select {_VOLUME}, {_SEGMENT_MEANS} from authors group by segment")
def segment_shares(spark, sf_dir):
    return behavior.segment_shares(author_table(spark, sf_dir))


@query(
    "theme_rollup",
    f"select {_ROLLUP}, cast(sum(distinct_authors) as bigint) as distinct_authors from reaction group by theme",
)
def theme_rollup(spark, sf_dir):
    return behavior.theme_rollup(reaction_table(spark, sf_dir))


@query(
    "page_comparison",
    """select page_name, count(distinct external_post_id) as post_count, count(*) as comment_count,
         count(distinct author_pseudo) as author_count, round(median(reaction_delay_hours), 6) as median_delay_hours,
         round(avg(comment_length), 6) as avg_comment_length from valid group by page_name""",
)
def page_comparison(spark, sf_dir):
    return behavior.page_comparison(context_table(spark, sf_dir))


@query(
    "hourly_activity",
    """select cast(h.hour as int) as hour, count(v.comment_id) as comment_count from range(24) h(hour)
       left join valid v on v.comment_hour = h.hour group by 1""",
)
def hourly_activity(spark, sf_dir):
    return behavior.hourly_activity(context(spark, sf_dir))


@query(
    "report_scope",
    """select count(*) as comment_count, count(distinct author_pseudo) as author_count,
         count(distinct external_post_id) as post_count, count(distinct theme) as theme_count from context""",
)
def report_scope(spark, sf_dir):
    return behavior.report_scope(context(spark, sf_dir))


@query("reactivity", f"select {_WITHIN} from valid")
def reactivity(spark, sf_dir):
    return behavior.reactivity(context_table(spark, sf_dir))


@query(
    "segment_report",
    f"""select segment, count(*) as author_count, cast(sum(comment_count) as bigint) as comment_count, {_SEGMENT_MEANS}
        from authors group by segment""",
)
def segment_report(spark, sf_dir):
    return behavior.segment_report(author_table(spark, sf_dir))


@query("theme_report", f"select {_ROLLUP} from reaction group by theme")
def theme_report(spark, sf_dir):
    return behavior.theme_report(reaction_table(spark, sf_dir))


@query(
    "cross_page_audience",
    """select count(*) as shared_authors from (
         select author_pseudo from context group by author_pseudo having count(distinct page_name) > 1)""",
)
def cross_page_audience(spark, sf_dir):
    return behavior.cross_page_audience(context(spark, sf_dir))


@query(
    "format_effect",
    """select media_type, count(distinct external_post_id) as post_count, count(*) as comment_count,
         round(count(*) * 1.0::double / count(distinct external_post_id), 6) as comments_per_post,
         round(median(reaction_delay_hours), 6) as median_delay_hours from valid group by media_type""",
)
def format_effect(spark, sf_dir):
    return behavior.format_effect(context_table(spark, sf_dir))


_PEAK = """select h.hour as peak_hour, h.n as peak_count, l.hour as trough_hour, l.n as trough_count,
  round(case when l.n = 0 then 0 else h.n * 1.0::double / l.n end, 6) as amplitude
  from (select hour, n from hours order by n desc, hour limit 1) h, (select hour, n from hours order by n, hour limit 1) l"""


@query(
    "hour_peak_trough",
    f"""select * from (with hours as (select comment_hour as hour, count(*) as n from context group by 1) {_PEAK})""",
)
def hour_peak_trough(spark, sf_dir):
    return behavior.hour_peak_trough(behavior.hour_counts(context(spark, sf_dir)))


@query(
    "hour_peak_trough_zero_filled",
    f"""select * from (with hours as (select cast(r.hour as int) as hour, count(v.comment_id) as n
          from range(24) r(hour) left join valid v on v.comment_hour = r.hour group by 1) {_PEAK})""",
)
def hour_peak_trough_zero_filled(spark, sf_dir):
    return behavior.hour_peak_trough(hourly_activity(spark, sf_dir))


@query(
    "voice_concentration",
    """select round(100.0::double * count(*) filter (where segment in ('engage', 'hyperactif')) / count(*), 6) as author_share,
         round(100.0::double * sum(case when segment in ('engage', 'hyperactif') then comment_count else 0 end)
               / sum(comment_count), 6) as comment_share from authors""",
)
def voice_concentration(spark, sf_dir):
    return behavior.voice_concentration(author_segment(spark, sf_dir))


@query(
    "theme_extremes",
    """select f.theme as fastest_theme, round(f.d, 6) as fastest_delay_hours, w.theme as wordiest_theme,
         round(w.l, 6) as wordiest_length
       from (select theme, median(median_delay_hours) as d from reaction where theme <> 'non_classe' group by 1
             order by 2, 1 limit 1) f,
            (select theme, avg(avg_comment_length) as l from reaction where theme <> 'non_classe' group by 1
             order by 2 desc, 1 limit 1) w""",
)
def theme_extremes(spark, sf_dir):
    return behavior.theme_extremes(reaction_table(spark, sf_dir))


@query(
    "scale_to_max",
    """select theme, round(coalesce(m, 0) / greatest(0.1, max(m) over ()) * 100, 6) as median_delay_hours_scaled from (
         select theme, median(median_delay_hours) as m from reaction group by theme)""",
)
def scale_to_max(spark, sf_dir):
    themes = behavior.theme_report(reaction_table(spark, sf_dir))
    return behavior.scale_to_max(themes, ["median_delay_hours"], 0.1).select("theme", "median_delay_hours_scaled")


@query(
    "scale_shares_to_max",
    f"""select segment, round(author_share / greatest(1, max(author_share) over (), max(comment_share) over ()) * 100, 6)
          as author_share_scaled,
          round(comment_share / greatest(1, max(author_share) over (), max(comment_share) over ()) * 100, 6)
          as comment_share_scaled
        from (select segment, 100.0::double * count(*) / sum(count(*)) over () as author_share,
                100.0::double * sum(comment_count) / sum(sum(comment_count)) over () as comment_share
              from authors group by segment)""",
)
def scale_shares_to_max(spark, sf_dir):
    shares = segment_volume(spark, sf_dir)
    scaled = behavior.scale_to_max(shares, ["author_share", "comment_share"], 1)
    return scaled.select("segment", "author_share_scaled", "comment_share_scaled")
