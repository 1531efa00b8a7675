"""Registry of queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pulseloom.functions.text import WORD
from pulseloom.plans.bindings import TAXONOMY, VIEWS, check_view
from pulseloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits: sums differ in the last digits from engine to engine."""
    columns = [
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*columns)


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` names bound views and derived tables freely."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(function(tune(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            CHECKS[key] = with_views(sql)
        return function

    return register


def _theme_sql() -> str:
    """The labelled publications, as the checking engine computes them."""
    lists = []
    for name, terms in TAXONOMY.themes.items():
        cases = [
            f"case when regexp_matches(texte_publication, '(?i)(^|[^{WORD}]){t}($|[^{WORD}])') then '{t}' end" for t in terms
        ]
        lists.append(f"list_filter([{', '.join(cases)}], lambda x: x is not null) as k_{name}")
    names = list(TAXONOMY.themes)
    best = "greatest(" + ", ".join(f"len(k_{n})" for n in names) + ")"
    theme = "case when " + best + " < 1 then 'non_classe' " + " ".join(f"when len(k_{n}) = {best} then '{n}'" for n in names) + " end"
    hits = "case when " + best + " < 1 then [] " + " ".join(f"when len(k_{n}) = {best} then k_{n}" for n in names) + " end"
    return f"""select *, {theme} as theme, {best} as best, array_to_string({hits}, ', ') as matched_keywords
        from (select *, {', '.join(lists)} from publications)"""


_SEGMENT = """case when comment_count between 1 and 1 then 'ponctuel' when comment_count between 2 and 2 then 'occasionnel'
  when comment_count between 3 and 4 then 'regulier' when comment_count between 5 and 9 then 'engage'
  when comment_count >= 10 then 'hyperactif' end"""

# Tables the checks build on each other, in dependency order: name -> (needs, text).
DERIVED = {
    "labelled": (["publications"], _theme_sql()),
    "themes": (
        ["labelled"],
        """select id_publication as external_post_id, ecole as page_name, type_contenu as media_type, theme,
             matched_keywords, cast(best as int) as match_count, date_publication as published_at,
             likes as post_likes, partages as post_shares from labelled""",
    ),
    "context": (
        ["comments", "themes"],
        """select id_commentaire as comment_id, id_publication as external_post_id, pseudo_auteur as author_pseudo,
             ecole as page_name, coalesce(t.theme, 'non_classe') as theme, type_contenu as media_type,
             langue as language, date_commentaire as commented_at, date_publication as published_at,
             date_diff('second', date_publication, date_commentaire) / 3600.0::double as reaction_delay_hours,
             cast(extract(hour from date_commentaire) as int) as comment_hour,
             extract(dow from date_commentaire) in (0, 6) as is_weekend,
             cast(length(coalesce(texte, '')) as int) as comment_length
           from comments c left join themes t on t.external_post_id = c.id_publication
           where texte is not null and trim(texte) <> ''""",
    ),
    "valid": (["context"], "select * from context where reaction_delay_hours >= 0"),
    "authors": (
        ["valid"],
        f"""select *, {_SEGMENT} as segment from (
             select author_pseudo, count(*) as comment_count, count(distinct external_post_id) as distinct_posts,
               count(distinct theme) as distinct_themes, count(distinct page_name) as distinct_pages,
               median(reaction_delay_hours) as median_delay_hours, avg(comment_length) as avg_comment_length,
               min(commented_at) as first_seen_at, max(commented_at) as last_seen_at,
               count(distinct cast(commented_at as date)) as active_days
             from valid where author_pseudo is not null group by author_pseudo)""",
    ),
    "reaction": (
        ["valid", "themes"],
        """select c.theme, c.page_name, count(distinct c.external_post_id) as post_count, count(*) as comment_count,
             count(*) * 1.0::double / count(distinct c.external_post_id) as comments_per_post,
             count(distinct c.author_pseudo) as distinct_authors, median(c.reaction_delay_hours) as median_delay_hours,
             avg(c.comment_length) as avg_comment_length, median(t.post_likes) as median_post_likes
           from valid c left join themes t on t.external_post_id = c.external_post_id group by c.theme, c.page_name""",
    ),
    "kpis": (
        ["posts"],
        """select platform as platform_name, count(*) as post_count, median(total_engagement) as median_engagement,
             avg(total_engagement) as average_engagement,
             avg(engagement_rate_per_1k_followers) as average_engagement_rate,
             count(*) filter (where viral_coefficient >= 1) as viral_post_count, avg(toxicity_score) as average_toxicity
           from posts group by platform""",
    ),
    "daily": (
        ["posts"],
        """select cast(published_at as date) as activity_date, count(*) as post_count,
             cast(sum(total_engagement) as bigint) as total_engagement,
             avg(viral_coefficient) as average_viral_coefficient, avg(toxicity_score) as average_toxicity
           from posts group by 1""",
    ),
    "segment_rows": (
        ["posts"],
        """select 'topic' as dimension_name, coalesce(topic, 'unknown') as dimension_value, total_engagement as e,
             engagement_rate_per_1k_followers as r, viral_coefficient as v, toxicity_score as t from posts
           union all select 'media_type', coalesce(media_type, 'unknown'), total_engagement,
             engagement_rate_per_1k_followers, viral_coefficient, toxicity_score from posts
           union all select 'language', coalesce(language, 'unknown'), total_engagement,
             engagement_rate_per_1k_followers, viral_coefficient, toxicity_score from posts
           union all select 'sentiment', coalesce(sentiment_category, 'unknown'), total_engagement,
             engagement_rate_per_1k_followers, viral_coefficient, toxicity_score from posts
           union all select 'hashtag_bucket', case when num_hashtags = 0 then '0' when num_hashtags between 1 and 2
             then '1-2' when num_hashtags between 3 and 5 then '3-5' else '6+' end, total_engagement,
             engagement_rate_per_1k_followers, viral_coefficient, toxicity_score from posts""",
    ),
    "segments": (
        ["segment_rows"],
        """select row_number() over (order by dimension_name, dimension_value) as segment_id, * from (
             select dimension_name, dimension_value, count(*) as post_count, median(e) as median_engagement,
               avg(e) as average_engagement, avg(r) as average_engagement_rate,
               count(*) filter (where v >= 1) as viral_post_count, avg(t) as average_toxicity
             from segment_rows group by 1, 2)""",
    ),
    "staged1": (
        ["staging_v1"],
        """select * from staging_v1 qualify row_number() over (partition by comment_id order by ingested_at desc) = 1""",
    ),
    "fact1": (
        ["staged1"],
        """select row_number() over (order by comment_id) as post_id, comment_id, text, created_at, score,
             timestamp '2024-01-01 00:00:00' as effective_date from staged1""",
    ),
    "change2": (
        ["staging_v2", "fact1"],
        """select s.*, f.comment_id is not null as is_update from staging_v2 s left join fact1 f using (comment_id)
           where f.comment_id is null or coalesce(s.text, '') <> coalesce(f.text, '')
              or coalesce(cast(s.score as varchar), '') <> coalesce(cast(f.score as varchar), '')""",
    ),
    "split": (
        ["posts"],
        """select *, row_number() over (order by published_at, post_id) as time_rank,
             row_number() over (order by published_at, post_id) <= cast(floor(count(*) over () * 0.8) as bigint) as is_train
           from posts""",
    ),
}


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b(?:from|join)\s+{name}\b", text, re.IGNORECASE) is not None


def with_views(sql: str) -> str:
    """Put the views a statement uses before it as common table expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in needed:
            return
        for inner in DERIVED.get(name, ([], ""))[0]:
            need(inner)
        needed.append(name)

    for name in [*VIEWS, *DERIVED]:
        if _mentions(sql, name):
            need(name)
    if not needed:
        return sql
    body = ",\n".join(f"{n} as ({check_view(n) if n in VIEWS else DERIVED[n][1]})" for n in needed)
    return f"with {body}\n{sql}"
