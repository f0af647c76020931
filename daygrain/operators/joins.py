"""Joins against small tables whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.operators.series import block_number, meet, whole

#: Broadcast limits. Rows alone say little where keys may have any length.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 20 << 20


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether rows, and their bytes written out as JSON, are within both limits.

    Counting stops at the limit of rows, so a large table is not scanned to its end.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.octet_length(row))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast after measuring; otherwise leave the join to Spark."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def attach_series_stats(
    df: DataFrame,
    series: str,
    stats: Mapping[str, Column],
    time: str = "date",
    block_days: int | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Give every row the aggregates of its own series.

    Rows without a series form one of their own. Three plans with equal rows; a window
    and an aggregate may add doubles in another order, so that the last bits of an
    average can differ between them:

    * by default one window over each series: one scan, one shuffle on the key;
    * ``max_broadcast_rows`` set: measure the series, and where they fit, aggregate and
      broadcast, so that the rows do not move at all. This reads the input again,
      which pays off on a stored table rather than on a derived one;
    * ``block_days`` set: aggregate, then join on (series, calendar block), which
      splits a long series over several tasks.
    """
    columns = [expr.alias(name) for name, expr in stats.items()]
    if block_days:
        blocked = df.withColumn("_block", block_number(time, block_days))
        known = blocked.select(series, "_block").distinct()
        per_block = meet(known, df.groupBy(series).agg(*columns), [series])
        return meet(blocked, per_block, [series, "_block"]).drop("_block")
    if max_broadcast_rows is not None:
        if fits_broadcast(df.select(series).distinct(), max_broadcast_rows):
            return meet(df, F.broadcast(df.groupBy(series).agg(*columns)), [series])
    w = whole(series)
    return df.select("*", *[expr.over(w).alias(name) for name, expr in stats.items()])
