"""Exact group quantiles that hold when one group has most of the rows.

The built-in ``percentile`` keeps every distinct value of a group in one
aggregation buffer. That is fine up to a bound. Groups beyond it are narrowed in
two histogram steps, each a partial aggregation, until a handful of values is
left around the wanted rank. Both ways give the same linear interpolation.

Rows are first counted per (group, value). Sums and counts that are wanted next to
the quantile ride along in that step, so the input is scanned and shuffled once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.functions.joins import null_safe_join
from pulseloom.session import materialise

# Distinct values one aggregation buffer may hold before the histogram way is taken.
MAX_BUFFERED_VALUES = 1_000_000
_LOG_BUCKETS_PER_UNIT = 1024
_LINEAR_BUCKETS = 65_536


class Measure(NamedTuple):
    """An aggregate in two steps: per (group, value), then per group."""

    alias: str
    partial: list[Column]
    final: Column


def rows(alias: str) -> Measure:
    return Measure(alias, [F.count(F.lit(1)).alias(f"_m_{alias}")], F.coalesce(F.sum(f"_m_{alias}"), F.lit(0)).alias(alias))


def rows_where(condition: Column, alias: str) -> Measure:
    return Measure(alias, [F.count_if(condition).alias(f"_m_{alias}")], F.coalesce(F.sum(f"_m_{alias}"), F.lit(0)).alias(alias))


def total(column: str, alias: str) -> Measure:
    return Measure(alias, [F.sum(column).alias(f"_m_{alias}")], F.sum(f"_m_{alias}").alias(alias))


def mean(column: str, alias: str) -> Measure:
    parts = [F.sum(column).alias(f"_ms_{alias}"), F.count(column).alias(f"_mc_{alias}")]
    return Measure(alias, parts, F.try_divide(F.sum(f"_ms_{alias}").cast("double"), F.sum(f"_mc_{alias}")).alias(alias))


def least(column: str, alias: str) -> Measure:
    return Measure(alias, [F.min(column).alias(f"_m_{alias}")], F.min(f"_m_{alias}").alias(alias))


def largest(column: str, alias: str) -> Measure:
    return Measure(alias, [F.max(column).alias(f"_m_{alias}")], F.max(f"_m_{alias}").alias(alias))


def summarise(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    measures: list[Measure] | None = None,
    weight: str | None = None,
    max_buffered: int | None = None,
) -> DataFrame:
    """One row per group: the measures, and a continuous quantile of ``value`` per alias.

    NULL values are left out of the quantiles, as by a SQL aggregate. ``weight`` is
    an integer column saying how often a row counts. Without groups the result is
    one row.
    """
    measures = measures or []
    limit = MAX_BUFFERED_VALUES if max_buffered is None else max_buffered
    count = F.sum(F.col(weight)).cast("long") if weight else F.count(F.lit(1))
    partials = [c for m in measures for c in m.partial]
    grain = df.groupBy(*groups, F.col(value).cast("double").alias("_v")).agg(count.alias("_n"), *partials)
    return from_grain(materialise(grain, "quantile"), groups, quantiles, measures, limit)


def from_grain(
    grain: DataFrame, groups: list[str], quantiles: dict[str, float], measures: list[Measure] | None = None, max_buffered: int | None = None
) -> DataFrame:
    """``summarise`` from rows already counted per (group, value): ``_v`` is the value, ``_n`` its count.

    Rows without a value take part in the measures only. ``grain`` is read several
    times, so it should be a written table.
    """
    measures = measures or []
    limit = MAX_BUFFERED_VALUES if max_buffered is None else max_buffered
    keys = groups or ["_all"]
    keyed = grain if groups else grain.withColumn("_all", F.lit(0))
    hot = keyed.groupBy(*keys).agg(F.count("_v").alias("_distinct")).where(F.col("_distinct") > limit).select(*keys)
    points = F.array(*[F.lit(float(p)) for p in quantiles.values()])
    finals = [m.final for m in measures]
    if hot.isEmpty():
        found = grain.groupBy(*groups).agg(*finals, F.percentile("_v", points, F.col("_n")).alias("_q"))
        return found.select(*groups, *[m.alias for m in measures], *[F.col("_q")[i].alias(a) for i, a in enumerate(quantiles)])

    # A hot group has more than ``limit`` distinct values, so there are at most
    # (distinct pairs / limit) of them: a size bound for the broadcasts here and below.
    flagged = null_safe_join(keyed, F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    cold_value = F.when(F.col("_hot").isNull(), F.col("_v"))
    found = flagged.groupBy(*keys).agg(*finals, F.percentile(cold_value, points, F.col("_n")).alias("_q"))
    pairs = flagged.where(F.col("_hot") & F.col("_v").isNotNull() & (F.col("_n") > 0)).select(*keys, "_v", "_n")
    selected = _by_histogram(pairs, keys, {f"_h_{a}": p for a, p in quantiles.items()})
    joined = null_safe_join(found, selected, keys, "left")
    picks = [F.coalesce(f"_h_{a}", F.col("_q")[i]).alias(a) for i, a in enumerate(quantiles)]
    return joined.select(*groups, *[m.alias for m in measures], *picks)


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: dict[str, float],
    weight: str | None = None,
    max_buffered: int | None = None,
) -> DataFrame:
    """``summarise`` without measures."""
    return summarise(df, groups, value, quantiles, weight=weight, max_buffered=max_buffered)


def _by_histogram(pairs: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    value = F.col("_v")
    # log1p is semi-monotonic, so equal-or-larger values never land in a lower bucket.
    coarse = F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(_LOG_BUCKETS_PER_UNIT))
    bucketed = pairs.withColumn("_b", coarse)
    histogram = bucketed.groupBy(*keys, "_b").agg(
        F.sum("_n").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.withColumn("_total", F.sum("_c").over(whole)).withColumn(
        "_before", F.coalesce(F.sum("_c").over(before), F.lit(0))
    )
    targets = _rank_targets(ranked, quantiles).where(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))
    )
    targets = targets.withColumn("_rank", F.col("_rank") - F.col("_before")).select(
        *keys, "_b", "_alias", "_side", "_share", "_rank", "_lo", "_hi"
    )
    # Two ranks per quantile and hot group: bounded like the hot groups themselves.
    near = null_safe_join(bucketed, F.broadcast(targets), [*keys, "_b"])

    span = F.col("_hi") - F.col("_lo")
    fine = F.when(span > 0, F.floor((value - F.col("_lo")) / span * F.lit(_LINEAR_BUCKETS - 1))).otherwise(F.lit(0))
    near = near.withColumn("_s", fine.cast("long"))
    slot = [*keys, "_alias", "_side"]
    fine_histogram = near.groupBy(*slot, "_share", "_rank", "_s").agg(F.sum("_n").alias("_c"))
    fine_before = Window.partitionBy(*slot).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        fine_histogram.withColumn("_before", F.coalesce(F.sum("_c").over(fine_before), F.lit(0)))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
        .select(*slot, "_s", (F.col("_rank") - F.col("_before")).alias("_left"))
    )
    last = null_safe_join(near, F.broadcast(hit), [*slot, "_s"])
    upto = Window.partitionBy(*slot).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = (
        last.withColumn("_upto", F.sum("_n").over(upto))
        .where(F.col("_upto") > F.col("_left"))
        .groupBy(*slot, "_share")
        .agg(F.min("_v").alias("_v"))
    )

    def point(alias: str) -> Column:
        mine = F.col("_alias") == alias
        low = F.max(F.when(mine & (F.col("_side") == "low"), F.col("_v")))
        high = F.max(F.when(mine & (F.col("_side") == "high"), F.col("_v")))
        share = F.max(F.when(mine, F.col("_share")))
        return F.when(share == 0, low).otherwise(low + (high - low) * share).alias(alias)

    return chosen.groupBy(*keys).agg(*[point(a) for a in quantiles])


def _rank_targets(ranked: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Add the zero-based ranks on both sides of each wanted position."""
    entries = []
    for alias, p in quantiles.items():
        position = (F.col("_total") - 1) * F.lit(float(p))
        share = (position - F.floor(position)).alias("_share")
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            entries.append(
                F.struct(F.lit(alias).alias("_alias"), F.lit(side).alias("_side"), share, rank.alias("_rank"))
            )
    return ranked.select("*", F.inline(F.array(*entries)))
