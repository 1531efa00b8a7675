"""Equi-joins whose keys may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL, keeping the left key columns."""
    if not keys:
        # Only frames of one row reach this branch: there is nothing to join on.
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"_r_{k}" for k in keys]) if how not in ("left_anti", "left_semi") else joined
