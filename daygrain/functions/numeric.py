"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x: Column | str, digits: int) -> Column:
    """Round to ``digits`` (at most 5) places, halves away from zero.

    The value is first rounded to six places, so that 1.005 becomes 1.01 on every
    engine, as ``round(cast(x as decimal(18, 6)), digits)`` does. Counting in
    millionths as a long gives the same without a decimal object per value, which
    was most of the cost of a rolling average. From 1e9 up, where a double no longer
    holds six places, the double itself is rounded; NaN and infinities stay as they are.

    ``x`` is evaluated more than once: give a column, not a window expression.
    """
    x = as_column(x)
    size = F.abs(x)
    step = 10 ** (6 - digits)
    millionths = F.floor(size * 1e6 + 0.5) + step // 2
    kept = millionths - millionths % step
    near = F.when(x < 0, -kept).otherwise(kept) / F.lit(1e6)
    far = F.round(x.cast("double"), digits)
    return F.when(size < 1e9, near).otherwise(far)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; an unknown condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
