"""Seeded, exact row choice by hash, and content-based identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.functions.joins import null_safe_join
from pulseloom.session import materialise


def seeded_hash(key: Column, seed: int = 42) -> Column:
    """Hex digest that orders rows the same way in every engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def hash_cut(df: DataFrame, digest: str, groups: list[str], quotas: DataFrame) -> DataFrame:
    """Per group, the digest of the row that fills its ``_quota``.

    Rows with a digest up to ``_cut`` are exactly the quota, provided digests are
    unique. A histogram of the first four hex digits finds the bucket in question,
    so only about 1/65,536 of a group is sorted, and no group meets in one task.
    """
    head = F.substring(digest, 1, 4)
    keys = groups or ["_all"]
    source = (df if groups else df.withColumn("_all", F.lit(0))).withColumn("_head", head)
    limits = quotas if groups else quotas.withColumn("_all", F.lit(0))
    histogram = source.groupBy(*keys, "_head").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    histogram = histogram.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    crossing = null_safe_join(histogram, limits, keys).where(
        (F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_before") + F.col("_c"))
    )
    # Written down first: Catalyst then knows its size when it picks the join.
    crossing = materialise(crossing.select(*keys, "_head", (F.col("_quota") - F.col("_before")).alias("_need")), "cut")
    bucket = null_safe_join(source.select(*keys, "_head", digest), crossing, [*keys, "_head"])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(digest))
    cuts = bucket.withColumn("_place", place).where(F.col("_place") == F.col("_need"))
    cuts = cuts.select(*keys, F.col(digest).alias("_cut"))
    return materialise(cuts if groups else cuts.drop("_all"), "cut")


def flag_by_quota(
    df: DataFrame, key: Column, groups: list[str], quotas: DataFrame, alias: str, seed: int = 42
) -> DataFrame:
    """Add a boolean that is true on exactly ``_quota`` rows of each group.

    ``key`` must be unique. Groups that are smaller than their quota are taken
    whole; groups without a quota, or with quota 0, give no row.
    """
    hashed = df.withColumn("_digest", seeded_hash(key, seed))
    sizes = hashed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    limits = null_safe_join(sizes, quotas, groups).select(*groups, F.least("_quota", "_size").alias("_quota"))
    cuts = hash_cut(hashed, "_digest", groups, limits)
    if groups:
        joined = null_safe_join(hashed, cuts, groups, "left")
    else:
        joined = hashed.crossJoin(F.broadcast(cuts.agg(F.max("_cut").alias("_cut"))))
    chosen = F.coalesce(F.col("_digest") <= F.col("_cut"), F.lit(False))
    return joined.withColumn(alias, chosen).drop("_digest", "_cut")


def stable_id(columns: list[str]) -> Column:
    """md5 of the row's columns joined by ``|``, modulo 2^62, as a BIGINT."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])
    digest = F.md5(text)
    low = F.conv(F.substring(digest, 18, 15), 16, 10).cast("long")
    high = F.conv(F.substring(digest, 17, 1), 16, 10).cast("long") % 4
    return F.shiftleft(high, 60).bitwiseOR(low)
