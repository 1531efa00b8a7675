"""Theme labelling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulseloom.operators import themes
from pulseloom.plans.bindings import dealt, TAXONOMY, view
from pulseloom.plans.registry import query


def post_themes(spark, sf_dir):
    """The theme dimension, from the posts at their own grain."""
    return themes.build_post_theme(view(spark, sf_dir, "publications"), TAXONOMY)


@query(
    "posts_from_comments",
    """select id_publication, min(ecole) as ecole, min(type_contenu) as type_contenu,
         min(texte_publication) as texte_publication, min(date_publication) as date_publication, min(likes) as likes,
         min(partages) as partages from comments group by id_publication""",
)
def posts_from_comments(spark, sf_dir):
    return themes.posts_from_comments(view(spark, sf_dir, "comments"))


@query(
    "keyword_hits",
    """select id_publication, array_to_string(k_licence, ', ') as licence, array_to_string(k_annonce, ', ') as annonce,
         array_to_string(k_generique, ', ') as generique, array_to_string(k_francais, ', ') as francais from labelled""",
)
def keyword_hits(spark, sf_dir):
    hits = themes.keyword_hits(dealt(view(spark, sf_dir, "publications")), "texte_publication", TAXONOMY)
    names = [F.array_join(F.col("hits")[i]["keywords"], ", ").alias(n) for i, n in enumerate(TAXONOMY.themes)]
    return hits.select("id_publication", *names)


@query(
    "classify_theme",
    "select id_publication, theme, matched_keywords, cast(best as int) as match_count from labelled",
)
def classify_theme(spark, sf_dir):
    labelled = themes.classify_theme(dealt(view(spark, sf_dir, "publications")), "texte_publication", TAXONOMY)
    return labelled.select(
        "id_publication", "theme", F.array_join("matched_keywords", ", ").alias("matched_keywords"), "match_count"
    )


@query(
    "build_post_theme",
    """select t.external_post_id, t.page_name, c.media_type, t.theme, t.matched_keywords, t.match_count, t.published_at,
         t.post_likes, t.post_shares from themes t
       join (select id_publication, min(type_contenu) as media_type from comments group by 1) c
         on c.id_publication = t.external_post_id""",
)
def build_post_theme(spark, sf_dir):
    return themes.build_post_theme(posts_from_comments(spark, sf_dir), TAXONOMY)


@query(
    "theme_distribution",
    """select theme, count(*) as post_count, round(100.0::double * count(*) / sum(count(*)) over (), 6) as share,
         round(100.0::double * sum(case when theme <> 'non_classe' then count(*) else 0 end) over ()
               / sum(count(*)) over (), 6) as coverage,
         100.0::double * sum(case when theme <> 'non_classe' then count(*) else 0 end) over ()
               / sum(count(*)) over () < 70 as low_coverage
       from themes group by theme""",
)
def theme_distribution(spark, sf_dir):
    return themes.theme_distribution(post_themes(spark, sf_dir))
