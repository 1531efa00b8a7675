"""Seeded sample extraction and comment enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.functions.hashing import flag_by_quota, seeded_hash


def binary_rating(label: Column, high, low) -> Column:
    """A two-valued label as a rating; anything but 1 is low."""
    return F.when(label == 1, high).otherwise(low)


def sample_extract(
    df: DataFrame,
    key: str,
    n: int,
    field_map: dict[str, str],
    synthesised: dict[str, Column],
    index_id: tuple[str, str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """``n`` rows by seeded hash of a unique key, with mapped and computed columns.

    ``index_id=(column, prefix)`` numbers the sample from 0 in hash order; only
    the ``n`` sampled rows are sorted for it.
    """
    spark = df.sparkSession
    quota = spark.range(1).select(F.lit(n).cast("long").alias("_quota"))
    taken = flag_by_quota(df, F.col(key), [], quota, "_in", seed).where("_in")
    columns = [F.col(src).alias(dst) for src, dst in field_map.items()]
    columns += [c.alias(name) for name, c in synthesised.items()]
    if index_id:
        place = F.row_number().over(Window.orderBy(seeded_hash(F.col(key), seed))) - 1
        columns.append(F.concat(F.lit(index_id[1]), place.cast("string")).alias(index_id[0]))
    return taken.select(*columns)


def enrich_comments(comments: DataFrame, publications: DataFrame, order: str) -> DataFrame:
    """Attach its publication to each comment; the last publication of a key wins.

    ``order`` is the publications' file order. Both sides must carry the key and
    text columns; unmatched comments stay, with NULLs.
    """
    key = ["plateforme", "id_publication"]
    need_c = {*key, "id_commentaire", "texte"} - set(comments.columns)
    need_p = {*key, "texte"} - set(publications.columns)
    if need_c or need_p:
        raise ValueError(f"missing columns: comments {sorted(need_c)}, publications {sorted(need_p)}")
    context = [c for c in publications.columns if c not in (*key, "texte", order)]
    row = F.struct(F.col("texte").alias("texte_publication"), *context)
    # max_by is a partial aggregation: many copies of one publication shrink before the shuffle.
    last = publications.groupBy(*key).agg(F.max_by(row, F.col(order)).alias("_p")).select(*key, "_p.*")
    return comments.join(last, key, "left")
