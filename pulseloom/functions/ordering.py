"""Global ranks and running sums without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.session import materialise

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partition and sort; a seeded salt splits rows that tie on every key."""
    salted = df.withColumn("_salt", F.rand(42))
    keys = [*order, F.col("_salt")]
    return salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")


def global_rank(df: DataFrame, order: list[Column], alias: str = "rank", start: int = 0) -> DataFrame:
    """Add ``start + 1, start + 2, ...`` in the given order.

    One range shuffle, one written table, then an offset per partition. The
    offsets have one row per partition, which bounds window and broadcast.
    """
    placed = _range_sorted(df, order).withColumn("_place", F.monotonically_increasing_id())
    fixed = materialise(placed, "rank")
    part = F.shiftright("_place", _ROW_BITS)
    sizes = fixed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    ranked = fixed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    within = F.col("_place").bitwiseAND(F.lit(_ROW_MASK)) + 1
    return ranked.withColumn(alias, (F.lit(start) + F.col("_offset") + within).cast("long")).drop(
        "_part", "_place", "_offset"
    )


def running_sums(df: DataFrame, order: list[Column], measures: dict[str, str]) -> DataFrame:
    """Add a running sum over the whole frame per ``{alias: column}``.

    Rows must be unique on ``order``; aggregate to that grain first.
    """
    fixed = materialise(_range_sorted(df, order).withColumn("_part", F.spark_partition_id()), "running")
    totals = fixed.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{a}") for a, c in measures.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_t_{a}").over(earlier), F.lit(0)).alias(f"_o_{a}") for a in measures]
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = fixed.join(F.broadcast(offsets), "_part")
    for alias, column in measures.items():
        summed = summed.withColumn(alias, F.sum(column).over(inside) + F.col(f"_o_{alias}"))
    return summed.drop("_part", *[f"_o_{a}" for a in measures])
