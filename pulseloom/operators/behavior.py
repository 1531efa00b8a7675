"""How the public reacts: comments in the context of the post they answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.functions.joins import null_safe_join
from pulseloom.functions.quantiles import Measure, exact_quantiles, from_grain, largest, least, mean, rows, rows_where, summarise, total
from pulseloom.functions.times import hours_between
from pulseloom.session import materialise

FALLBACK_THEME = "non_classe"
# Bounds and names of the author segments, in rising intensity.
SEGMENTS = [
    (1, 1, "ponctuel"),
    (2, 2, "occasionnel"),
    (3, 4, "regulier"),
    (5, 9, "engage"),
    (10, None, "hyperactif"),
]
ACTIVE_SEGMENTS = ["engage", "hyperactif"]


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100), whole)


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole)


def _n(alias: str = "comment_count") -> Column:
    return F.count(F.lit(1)).alias(alias)


def valid_delay(context: DataFrame) -> DataFrame:
    """Without comments dated before their post, which are corrupt dates."""
    return context.where(F.col("reaction_delay_hours") >= 0)


def reaction_delay(df: DataFrame) -> DataFrame:
    return df.withColumn("reaction_delay_hours", hours_between(F.col("date_publication"), F.col("date_commentaire")))


def time_features(df: DataFrame, ts: str = "date_commentaire") -> DataFrame:
    return df.withColumns({"comment_hour": F.hour(ts), "is_weekend": F.dayofweek(ts).isin(1, 7)})


def comment_length(df: DataFrame, text: str = "texte") -> DataFrame:
    return df.withColumn("comment_length", F.length(F.coalesce(F.col(text), F.lit(""))))


def comment_context(comments: DataFrame, themes: DataFrame) -> DataFrame:
    """Non-blank comments with the theme of their post.

    The theme side has one row per post. Catalyst broadcasts it while it is small;
    beyond that a post with very many comments is split by the skew join.
    """
    written = comments.where(F.col("texte").isNotNull() & (F.trim("texte") != ""))
    featured = comment_length(time_features(reaction_delay(written)))
    labels = themes.select(F.col("external_post_id").alias("id_publication"), "theme")
    return featured.join(labels, "id_publication", "left").select(
        F.col("id_commentaire").alias("comment_id"),
        F.col("id_publication").alias("external_post_id"),
        F.col("pseudo_auteur").alias("author_pseudo"),
        F.col("ecole").alias("page_name"),
        F.coalesce("theme", F.lit(FALLBACK_THEME)).alias("theme"),
        F.col("type_contenu").alias("media_type"),
        F.col("langue").alias("language"),
        F.col("date_commentaire").alias("commented_at"),
        F.col("date_publication").alias("published_at"),
        "reaction_delay_hours",
        "comment_hour",
        "is_weekend",
        "comment_length",
    )


def negative_delay_count(context: DataFrame) -> DataFrame:
    return context.agg(
        _n(),
        F.count_if(F.col("reaction_delay_hours") < 0).alias("negative_count"),
    )


def author_segment(count: Column) -> Column:
    """The segment of a comment count, from one table of bounds."""
    result = None
    for low, high, name in SEGMENTS:
        inside = count >= low if high is None else count.between(low, high)
        result = F.when(inside, name) if result is None else result.when(inside, name)
    return result


def _grain(rows: DataFrame, groups: list[str], counted: dict[str, Column]) -> DataFrame:
    """Rows per (group, kind, value), written: the distinct values of each kind, and the delays, in one shuffle.

    Every comment gives one entry per counted column and one for its delay (``kind``
    NULL, value ``_v``). They are counted on the map side, so repeated values collapse
    before the shuffle, and an author or page with very many comments is dealt over all
    tasks by its values.
    """
    none = F.lit(None)
    entries = [F.struct(F.lit(k).alias("_kind"), c.cast("string").alias("_s"), none.cast("double").alias("_v")) for k, c in counted.items()]
    entries.append(F.struct(none.cast("string").alias("_kind"), none.cast("string").alias("_s"), F.col(_DELAY).cast("double").alias("_v")))
    each = rows.select(*groups, "comment_length", "commented_at", F.explode(F.array(*entries)).alias("_e"))
    counts = each.groupBy(*groups, F.col("_e._kind").alias("_kind"), F.col("_e._s").alias("_s"), F.col("_e._v").alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("comment_length").alias("_len"),
        F.min("commented_at").alias("_first"),
        F.max("commented_at").alias("_last"),
    )
    return materialise(counts, "grain")


def _final(alias: str, column: Column) -> Measure:
    """A measure over the rows of a grain, which hold its parts already."""
    return Measure(alias, [], column.alias(alias))


def _comment_measures() -> list[Measure]:
    delays = F.col("_kind").isNull()
    n = F.sum(F.when(delays, F.col("_n")))
    return [_final("comment_count", n), _final("avg_comment_length", F.sum(F.when(delays, F.col("_len"))) / n)]


def _distinct(alias: str, kind: str) -> Measure:
    """Distinct values of a kind; NULL is none."""
    return _final(alias, F.count_if((F.col("_kind") == kind) & F.col("_s").isNotNull()))


def author_profile(context: DataFrame, **options) -> DataFrame:
    """One row per named author over comments with a valid delay."""
    rows = valid_delay(context).where(F.col("author_pseudo").isNotNull())
    counted = {"post": F.col("external_post_id"), "theme": F.col("theme"), "page": F.col("page_name"), "day": F.col("commented_at").cast("date")}
    grain = _grain(rows, ["author_pseudo"], counted)
    measures = [
        *_comment_measures(),
        _distinct("distinct_posts", "post"),
        _distinct("distinct_themes", "theme"),
        _distinct("distinct_pages", "page"),
        _distinct("active_days", "day"),
        _final("first_seen_at", F.min("_first")),
        _final("last_seen_at", F.max("_last")),
    ]
    profile = from_grain(grain, ["author_pseudo"], {"median_delay_hours": 0.5}, measures, **options)
    return profile.withColumn("segment", author_segment(F.col("comment_count")))


def unnamed_authors(context: DataFrame) -> DataFrame:
    """Comments without an author: they have no profile."""
    return context.agg(F.count_if(F.col("author_pseudo").isNull()).alias("unnamed_comments"))


def segment_volume(profile: DataFrame) -> DataFrame:
    """Authors and comments per segment with their shares."""
    per = profile.groupBy("segment").agg(_n("author_count"), F.sum("comment_count").alias("comment_count"))
    return _with_shares(per)


def _segment_figures(profile: DataFrame, **options) -> DataFrame:
    measures = [
        rows("author_count"),
        total("comment_count", "comment_count"),
        mean("avg_comment_length", "avg_comment_length"),
        mean("distinct_themes", "avg_distinct_themes"),
    ]
    return summarise(profile, ["segment"], "median_delay_hours", {"median_delay_hours": 0.5}, measures, **options)


def _with_shares(per: DataFrame) -> DataFrame:
    """Add author and comment shares. At most one row per segment on either side."""
    totals = per.agg(F.sum("author_count").alias("_a"), F.sum("comment_count").alias("_c"))
    shares = {
        "author_share": _percent(F.col("author_count"), F.col("_a")),
        "comment_share": _percent(F.col("comment_count"), F.col("_c")),
    }
    return per.crossJoin(F.broadcast(totals)).withColumns(shares).drop("_a", "_c")


def segment_shares(profile: DataFrame, **options) -> DataFrame:
    """Volumes, shares and means per segment, in rising intensity, unknown last."""
    rank = F.lit(99)
    for i, (_, _, name) in enumerate(SEGMENTS):
        rank = F.when(F.col("segment") == name, i).otherwise(rank)
    return _with_shares(_segment_figures(profile, **options)).orderBy(rank, "segment")


def segment_report(profile: DataFrame, **options) -> DataFrame:
    """Per segment by falling volume."""
    return _segment_figures(profile, **options).orderBy(F.col("comment_count").desc(), "segment")


def theme_reaction(context: DataFrame, themes: DataFrame, **options) -> DataFrame:
    """Reaction per theme and page.

    The median of post likes counts a post once per comment. The comments are counted
    once, per (theme, page, kind, value); the likes are joined to the rows of posts
    there, one per post, and weigh as many comments as it has.
    """
    keys = ["theme", "page_name"]
    counted = {"post": F.col("external_post_id"), "author": F.col("author_pseudo")}
    grain = _grain(valid_delay(context), keys, counted)
    measures = [*_comment_measures(), _distinct("post_count", "post"), _distinct("distinct_authors", "author")]
    figures = from_grain(grain, keys, {"median_delay_hours": 0.5}, measures, **options)
    per_post = grain.where((F.col("_kind") == "post") & F.col("_s").isNotNull()).select(*keys, F.col("_s").alias("external_post_id"), "_n")
    liked = per_post.join(themes.select("external_post_id", "post_likes"), "external_post_id")
    likes = exact_quantiles(liked, keys, "post_likes", {"median_post_likes": 0.5}, weight="_n", **options)
    result = null_safe_join(figures, likes, keys, "left")
    return result.withColumn("comments_per_post", _ratio(F.col("comment_count"), F.col("post_count")))


_DELAY = "reaction_delay_hours"
_DELAY_POINTS = {"median_delay_hours": 0.5, "p90_delay_hours": 0.9}


def _delay_summary(context: DataFrame, **options) -> DataFrame:
    """One row: period, comment count, shares of fast comments, median and p90 delay."""
    measures = [
        rows("comment_count"),
        rows_where(F.col(_DELAY) < 1, "_1h"),
        rows_where(F.col(_DELAY) < 6, "_6h"),
        least("commented_at", "period_start"),
        largest("commented_at", "period_end"),
    ]
    found = summarise(valid_delay(context), [], _DELAY, _DELAY_POINTS, measures, **options)
    shares = {f"pct_within_{h}": _percent(F.col(f"_{h}"), F.col("comment_count")) for h in ("1h", "6h")}
    return found.withColumns(shares).drop("_1h", "_6h")


def behavior_overview(context: DataFrame, **options) -> DataFrame:
    distinct = valid_delay(context).agg(
        F.count_distinct("external_post_id").alias("post_count"),
        F.count_distinct("author_pseudo").alias("author_count"),
        F.count_distinct("theme").alias("theme_count"),
    )
    # Two frames of one row.
    return _delay_summary(context, **options).crossJoin(F.broadcast(distinct))


def reactivity(context: DataFrame, **options) -> DataFrame:
    return _delay_summary(context, **options).drop("comment_count")


def report_scope(context: DataFrame) -> DataFrame:
    """Counts over all comments, invalid delays included."""
    return context.agg(
        _n(),
        F.count_distinct("author_pseudo").alias("author_count"),
        F.count_distinct("external_post_id").alias("post_count"),
        F.count_distinct("theme").alias("theme_count"),
    )


def _theme_totals(reaction: DataFrame, **options) -> DataFrame:
    """Per theme over pages: the median is one of page medians, the mean one of page means."""
    measures = [
        total("post_count", "post_count"),
        total("comment_count", "comment_count"),
        total("distinct_authors", "distinct_authors"),
        mean("avg_comment_length", "avg_comment_length"),
    ]
    totals = summarise(reaction, ["theme"], "median_delay_hours", {"median_delay_hours": 0.5}, measures, **options)
    return totals.withColumn("comments_per_post", _ratio(F.col("comment_count"), F.col("post_count")))


def theme_rollup(reaction: DataFrame, **options) -> DataFrame:
    """Themes by median delay. Authors are summed over pages, so one may count twice."""
    return _theme_totals(reaction, **options).orderBy(F.col("median_delay_hours").asc_nulls_last(), "theme")


def theme_report(reaction: DataFrame, **options) -> DataFrame:
    columns = ["theme", "post_count", "comment_count", "comments_per_post", "median_delay_hours", "avg_comment_length"]
    return theme_rollup(reaction, **options).select(*columns)


def _per_group(context: DataFrame, group: str, distinct: dict[str, str], **options) -> DataFrame:
    """Counts, mean length, median delay and distinct counts per group."""
    valid = valid_delay(context)
    measures = [rows("comment_count"), mean("comment_length", "avg_comment_length")]
    figures = summarise(valid, [group], _DELAY, {"median_delay_hours": 0.5}, measures, **options)
    counts = valid.groupBy(group).agg(*[F.count_distinct(c).alias(a) for a, c in distinct.items()])
    return null_safe_join(figures, counts, [group])


def page_comparison(context: DataFrame, **options) -> DataFrame:
    distinct = {"post_count": "external_post_id", "author_count": "author_pseudo"}
    return _per_group(context, "page_name", distinct, **options).orderBy("page_name")


def format_effect(context: DataFrame, **options) -> DataFrame:
    per = _per_group(context, "media_type", {"post_count": "external_post_id"}, **options).drop("avg_comment_length")
    ratio = _ratio(F.col("comment_count"), F.col("post_count"))
    return per.withColumn("comments_per_post", ratio).orderBy(F.col("comment_count").desc(), "media_type")


def zero_filled_hours(counts: DataFrame) -> DataFrame:
    """24 rows from (hour, comment_count) rows, 0 where an hour is absent."""
    hours = counts.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return (
        hours.join(counts, "hour", "left")
        .select("hour", F.coalesce("comment_count", F.lit(0)).alias("comment_count"))
        .orderBy("hour")
    )


def hourly_activity(context: DataFrame) -> DataFrame:
    return zero_filled_hours(valid_delay(context).groupBy(F.col("comment_hour").alias("hour")).agg(_n()))


def hour_counts(context: DataFrame) -> DataFrame:
    """Observed hours over all comments."""
    return context.groupBy(F.col("comment_hour").alias("hour")).agg(_n())


def hour_peak_trough(counts: DataFrame) -> DataFrame:
    """Busiest and quietest hour of (hour, comment_count) rows; the earlier hour wins a tie."""
    early = -F.col("hour")
    found = counts.agg(
        F.max_by(F.struct("hour", "comment_count"), F.struct(F.col("comment_count"), early)).alias("hi"),
        F.min_by(F.struct("hour", "comment_count"), F.struct("comment_count", "hour")).alias("lo"),
    )
    amplitude = F.when(F.col("lo.comment_count") == 0, F.lit(0).cast("double")).otherwise(
        _ratio(F.col("hi.comment_count"), F.col("lo.comment_count"))
    )
    return found.select(
        F.col("hi.hour").alias("peak_hour"),
        F.col("hi.comment_count").alias("peak_count"),
        F.col("lo.hour").alias("trough_hour"),
        F.col("lo.comment_count").alias("trough_count"),
        amplitude.alias("amplitude"),
    )


def cross_page_audience(context: DataFrame) -> DataFrame:
    """Authors seen on more than one page."""
    pages = context.groupBy("author_pseudo").agg(F.count_distinct("page_name").alias("pages"))
    return pages.where("pages > 1").agg(_n("shared_authors"))


def voice_concentration(profile: DataFrame) -> DataFrame:
    """Share of authors and of comments held by the two most active segments."""
    active = F.col("segment").isin(*ACTIVE_SEGMENTS)
    return profile.agg(
        _percent(F.count_if(active), F.count(F.lit(1))).alias("author_share"),
        _percent(F.sum(F.when(active, F.col("comment_count")).otherwise(0)), F.sum("comment_count")).alias("comment_share"),
    )


def theme_extremes(reaction: DataFrame, fallback: str = FALLBACK_THEME, **options) -> DataFrame:
    """The theme with the fastest and the one with the longest comments."""
    themes = _theme_totals(reaction, **options).where(F.col("theme") != fallback)
    fast = F.min_by(F.struct("theme", "median_delay_hours"), F.struct("median_delay_hours", "theme"))
    longest = F.min_by(F.struct("theme", "avg_comment_length"), F.struct(-F.col("avg_comment_length"), F.col("theme")))
    return themes.agg(fast.alias("f"), longest.alias("w")).select(
        F.col("f.theme").alias("fastest_theme"),
        F.col("f.median_delay_hours").alias("fastest_delay_hours"),
        F.col("w.theme").alias("wordiest_theme"),
        F.col("w.avg_comment_length").alias("wordiest_length"),
    )


def scale_to_max(df: DataFrame, columns: list[str], floor: float, suffix: str = "_scaled") -> DataFrame:
    """Each column as a percentage of the largest value over all of them, at least ``floor``."""
    peaks = df.agg(F.greatest(F.lit(float(floor)), *[F.max(c) for c in columns]).alias("_peak"))
    scaled = {c + suffix: F.coalesce(F.col(c), F.lit(0)) / F.col("_peak") * F.lit(100) for c in columns}
    # One row of peaks.
    return df.crossJoin(F.broadcast(peaks)).withColumns(scaled).drop("_peak")
