"""Arithmetic expressions: ratios, z-scores, composites."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Weights of the breakout score.
BREAKOUT_WEIGHTS = {"points": 0.5, "assists": 0.3, "plus_minus": 0.2}


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 unless the whole is positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """(value - mean) / deviation, 0 where the deviation is zero or unknown."""
    return F.when(deviation > 0, (value - mean) / deviation).otherwise(F.lit(0.0))


def composite(weights: Mapping[str, float]) -> Column:
    """Weighted sum of columns."""
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + F.lit(weight) * F.col(column)
    return total


def ceil_div(amount: Column, size: int) -> Column:
    """Number of bins of `size` that hold `amount`."""
    return F.ceil(amount / size)


def pair_number(index: Column, per_group: int = 2) -> Column:
    """Group that the 0-based `index` falls into when every group takes `per_group` rows."""
    return F.floor(index / per_group)


def truncate(value: Column) -> Column:
    """Whole part of a number, toward zero."""
    return value.cast("int")
