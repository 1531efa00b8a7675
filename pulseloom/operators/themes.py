"""Theme labels for posts from an auditable keyword taxonomy."""

from __future__ import annotations

from dataclasses import dataclass

import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.functions.text import contains_term, fold, fold_literal, is_single_word, words

COVERAGE_WARNING = 70.0


@dataclass(frozen=True)
class Taxonomy:
    """Themes in order of priority, each with its keywords."""

    themes: dict[str, list[str]]
    min_occurrences: int = 1
    fallback: str = "non_classe"

    @classmethod
    def read(cls, path: str) -> "Taxonomy":
        """From YAML: ``themes: {name: {mots_cles: [...]}}``, ``min_occurrences``, ``fallback``."""
        with open(path, encoding="utf-8") as handle:
            content = yaml.safe_load(handle)
        themes = {name: [str(k) for k in entry["mots_cles"]] for name, entry in content["themes"].items()}
        return cls(themes, content["min_occurrences"], content["fallback"])


def posts_from_comments(comments: DataFrame) -> DataFrame:
    """One row per post from comment-grain rows: the smallest value of each column.

    The post's columns repeat on each of its comments. The distinct step drops the
    repeats by hash on the map side, so the post text travels about once; a
    minimum over text alone would sort every comment first.
    """
    columns = ["ecole", "type_contenu", "texte_publication", "date_publication", "likes", "partages"]
    variants = comments.select("id_publication", *columns).distinct()
    return variants.groupBy("id_publication").agg(*[F.min(c).alias(c) for c in columns])


def _found_terms(folded: Column, taxonomy: Taxonomy) -> Column:
    """The folded keywords present in a folded text, each once."""
    lexicon = list(dict.fromkeys(fold_literal(k) for terms in taxonomy.themes.values() for k in terms))
    phrases = [k for k in lexicon if not is_single_word(k)]
    candidates = words(folded)
    if phrases:
        hits = F.array_compact(F.array(*[F.when(contains_term(folded, p), F.lit(p)) for p in phrases]))
        candidates = F.concat(candidates, hits)
    # One word split and one hash intersection serve every single-word keyword.
    return F.array_intersect(F.array(*[F.lit(k) for k in lexicon]), candidates)


def _theme_hits(found: str, terms: list[str]) -> Column:
    declared = list(dict.fromkeys(terms))
    if [fold_literal(t) for t in declared] == declared:
        return F.array_intersect(F.array(*[F.lit(t) for t in declared]), F.col(found))
    kept = [F.when(F.array_contains(found, fold_literal(t)), F.lit(t)) for t in declared]
    return F.array_compact(F.array(*kept))


def keyword_hits(df: DataFrame, text: str, taxonomy: Taxonomy) -> DataFrame:
    """Add ``hits``: per theme, in priority order, the distinct keywords found.

    Whole words, case ignored, any script. A NULL text has no hit.
    """
    folded = df.withColumn("_folded", fold(F.coalesce(F.col(text), F.lit(""))))
    found = folded.withColumn("_found", _found_terms(F.col("_folded"), taxonomy)).drop("_folded")
    entries = [
        F.struct(F.lit(name).alias("theme"), F.lit(-i).alias("priority"), _theme_hits("_found", terms).alias("keywords"))
        for i, (name, terms) in enumerate(taxonomy.themes.items())
    ]
    return found.withColumn("hits", F.array(*entries)).drop("_found")


def classify_theme(df: DataFrame, text: str, taxonomy: Taxonomy) -> DataFrame:
    """Add theme, matched_keywords (array) and match_count.

    Most keywords win, then the theme declared first; too few give the fallback.
    """
    scored = F.transform(
        "hits",
        lambda h: F.struct(
            F.size(h["keywords"]).alias("n"), h["priority"].alias("p"), h["theme"].alias("t"), h["keywords"].alias("k")
        ),
    )
    best = keyword_hits(df, text, taxonomy).withColumn("_best", F.array_max(scored)).drop("hits")
    enough = (F.col("_best.n") >= max(taxonomy.min_occurrences, 1)) & F.col("_best").isNotNull()
    return best.withColumns(
        {
            "theme": F.when(enough, F.col("_best.t")).otherwise(taxonomy.fallback),
            "matched_keywords": F.when(enough, F.col("_best.k")).otherwise(F.array().cast("array<string>")),
            "match_count": F.when(enough, F.col("_best.n")).otherwise(0),
        }
    ).drop("_best")


def build_post_theme(posts: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """The theme dimension from posts as ``posts_from_comments`` gives them."""
    return classify_theme(posts, "texte_publication", taxonomy).select(
        F.col("id_publication").alias("external_post_id"),
        F.col("ecole").alias("page_name"),
        F.col("type_contenu").alias("media_type"),
        "theme",
        F.array_join("matched_keywords", ", ").alias("matched_keywords"),
        "match_count",
        F.col("date_publication").alias("published_at"),
        F.col("likes").cast("long").alias("post_likes"),
        F.col("partages").cast("long").alias("post_shares"),
    )


def theme_distribution(themes: DataFrame, fallback: str = "non_classe") -> DataFrame:
    """Posts per theme with share, overall coverage, and a flag for low coverage."""
    counts = themes.groupBy("theme").agg(F.count(F.lit(1)).alias("post_count"))
    everything = Window.partitionBy()
    total = F.sum("post_count").over(everything)
    classified = F.sum(F.when(F.col("theme") != fallback, F.col("post_count")).otherwise(0)).over(everything)
    percent = F.lit(100).cast("double")
    # The window holds one row per theme of the taxonomy.
    return counts.select(
        "theme",
        "post_count",
        (percent * F.col("post_count") / total).alias("share"),
        (percent * classified / total).alias("coverage"),
        (percent * classified / total < COVERAGE_WARNING).alias("low_coverage"),
    ).orderBy(F.col("post_count").desc(), "theme")
