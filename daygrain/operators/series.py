"""Windows over daily series, whole or cut into calendar blocks.

The key (series, day) is unique, so a window over one series holds at most one
row per calendar day: a century is 36,525 rows, and the whole range of the DATE
type is 3.65 million. One task can hold that, and a large table has many series,
so the plain plan is one shuffle on the series key.

Where a single long series would still dominate a job, ``block_days`` cuts each
series into calendar blocks. Results are the same; the functions below carry over
what a block needs from the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Above this many calendar days per series, `choose_block_days` cuts series up.
MAX_SERIES_DAYS = 200_000

#: Rows without a day come first in their series.
_BEFORE_ALL_DAYS = -(2**31)


def ordered(keys: str | list[str], time: str) -> WindowSpec:
    # The default order, NULL days first, is the one tables are sorted by on write.
    return W.partitionBy(keys).orderBy(F.col(time).asc())


def rows_back(keys: str | list[str], time: str, preceding: int) -> WindowSpec:
    """The current row and ``preceding`` rows before it: rows, not days."""
    return ordered(keys, time).rowsBetween(-preceding, W.currentRow)


def running(keys: str | list[str], time: str) -> WindowSpec:
    return ordered(keys, time).rowsBetween(W.unboundedPreceding, W.currentRow)


def before(keys: str | list[str], order: str) -> WindowSpec:
    return ordered(keys, order).rowsBetween(W.unboundedPreceding, -1)


def whole(keys: str | list[str]) -> WindowSpec:
    return W.partitionBy(keys)


def block_number(time: str, days: int) -> Column:
    return F.floor(F.unix_date(F.col(time)) / F.lit(days)).cast("int")


def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL meets NULL, as it does in a window or a group."""
    named = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(named, same, how).drop(*[f"_right_{k}" for k in keys])


def choose_block_days(
    df: DataFrame, time: str = "date", max_days: int = MAX_SERIES_DAYS
) -> int | None:
    """Block length for a table, or None when no series can be too long.

    One job over the date column: the calendar span bounds the rows per series.
    """
    first, last = df.agg(F.min(time), F.max(time)).first()
    if first is None or (last - first).days < max_days:
        return None
    return max_days


def with_preceding_rows(
    df: DataFrame, series: str, time: str, preceding: int, block_days: int | None
) -> tuple[DataFrame, list[str]]:
    """Prepare a rolling frame of ``preceding`` rows; returns (rows, window keys).

    Without blocks the rows are unchanged. With blocks each row is also copied to
    every later block whose first frames reach back to it; copies are marked
    ``_copy`` and must be filtered out after the window. Frames count rows, so a
    block may need rows from several sparse blocks before it.
    """
    if not block_days:
        return df.withColumn("_copy", F.lit(False)), [series]

    blocked = df.withColumn("_block", block_number(time, block_days)).withColumn(
        "_day", F.coalesce(F.unix_date(F.col(time)), F.lit(_BEFORE_ALL_DAYS))
    )
    # Last days of each block: a rank limit that Spark applies before the shuffle as well.
    newest = W.partitionBy(series, "_block").orderBy(F.desc("_day"))
    last_rows = blocked.select(
        series, "_block", "_day", F.row_number().over(newest).alias("_age")
    ).filter(F.col("_age") <= preceding)
    tails = last_rows.groupBy(series, "_block").agg(F.collect_list("_day").alias("tail"))
    by_block = ordered(series, "_block")
    earlier = by_block.rowsBetween(-preceding, -1)
    later = by_block.rowsBetween(1, preceding)
    # Every earlier block has a row, so `preceding` of them always reach far enough.
    reach = tails.withColumn(
        "back",
        F.slice(F.sort_array(F.flatten(F.collect_list("tail").over(earlier)), asc=False), 1, preceding),
    ).withColumn("since", F.array_min("back"))
    feeds = reach.select(
        series,
        "_block",
        F.collect_list(F.struct("_block", "since")).over(later).alias("feeds"),
    )
    feeding = F.filter("feeds", lambda f: f["since"] <= F.col("_day"))
    targets = F.concat(F.array("_block"), F.transform(feeding, lambda f: f["_block"]))
    home = F.col("_block").alias("_home")
    rows = (
        meet(blocked, feeds, [series, "_block"])
        .select(*df.columns, home, F.explode(targets).alias("_block"))
        .withColumn("_copy", ~F.col("_block").eqNullSafe(F.col("_home")))
        .drop("_home")
    )
    return rows, [series, "_block"]
