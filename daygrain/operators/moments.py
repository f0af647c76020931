"""Moments of each series and month, which add up to fits and metrics without the rows.

One row per series and month: the number of rows, the moments of (day, value), the last day
with a value, and the newest points. Kept beside the fact table and renewed for the months
that an upsert touches, they answer everything a line needs: the moments of a series are those
of its months put together, its holdout is among the newest points of its months. A month has
at most 31 days, so a group never grows with the history, and a series has one row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points kept per month; a holdout has no more.
POINTS = 7

MOMENTS = ("n", "mean_x", "mean_y", "sxx", "syy", "sxy")


def day_number(time: str) -> Column:
    return F.unix_date(F.col(time)).cast("double")


def month_moments(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    target: str = "temp_max",
    points: int = POINTS,
    tasks: int | None = None,
) -> DataFrame:
    """(series, month, n_rows, moments, last_day, points); rows without a target count in ``n_rows`` only.

    One scan and one partial aggregation. Of the values, a day number and the target move.
    Lists do not fit a hash table of fixed width, so a task sorts what it gets; ``tasks`` deals
    the rows of a large table, of which few share a series and month, to so many before that.
    """
    df = df.select(
        F.col(series).alias("series"),
        F.trunc(time, "month").alias("month"),
        F.col(time).alias("_time"),
        F.col(target).alias("_target"),
    )
    if tasks:
        df = df.repartition(tasks, "series", "month")
    x, y = day_number("_time"), F.col("_target")
    observed = F.struct(x.alias("x"), y.alias("y"))
    newest = F.slice(F.sort_array(F.collect_list(F.when(y.isNotNull() & x.isNotNull(), observed)), asc=False), 1, points)
    return df.groupBy("series", "month").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.regr_count(y, x).alias("n"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_avgy(y, x).alias("mean_y"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.max(F.when(y.isNotNull(), F.col("_time"))).alias("last_day"),
        newest.alias("points"),
    )


def _total(items: str, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda sum_, item: sum_ + value(item))


def merged(moments: DataFrame, points: int = POINTS) -> DataFrame:
    """One row per series: the moments of all its months, its last day and newest points.

    Months are put together in their order, so that the same table gives the same bits.
    """
    named = [c for c in moments.columns if c not in ("series", "month")]
    rows = moments.groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct("month", *named))).alias("all"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.max("last_day").alias("last_day"),
    )
    rows = rows.withColumn("months", F.filter("all", lambda m: m["n"] > 0))
    for axis in ("x", "y"):
        weighted = _total("months", lambda m, axis=axis: m["n"] * m[f"mean_{axis}"])
        rows = rows.withColumn(f"mean_{axis}", F.try_divide(weighted, F.col("n")))

    def spread(a: str, b: str) -> Column:
        between = lambda m: m["n"] * (m[f"mean_{a}"] - F.col(f"mean_{a}")) * (m[f"mean_{b}"] - F.col(f"mean_{b}"))
        return F.when(F.col("n") > 0, _total("months", lambda m: m[f"s{a}{b}"] + between(m)))

    newest = F.slice(F.sort_array(F.flatten(F.transform("months", lambda m: m["points"])), asc=False), 1, points)
    return rows.select(
        "series",
        "n_rows",
        "n",
        "mean_x",
        "mean_y",
        spread("x", "x").alias("sxx"),
        spread("y", "y").alias("syy"),
        spread("x", "y").alias("sxy"),
        "last_day",
        newest.alias("points"),
    )


def of_points(points: str) -> list[Column]:
    """The moments of an array of points."""
    n = F.size(points).cast("bigint")
    mean = {axis: F.try_divide(_total(points, lambda p, axis=axis: p[axis]), n) for axis in ("x", "y")}

    def spread(a: str, b: str) -> Column:
        return _total(points, lambda p: (p[a] - mean[a]) * (p[b] - mean[b]))

    return [
        n.alias("n"),
        mean["x"].alias("mean_x"),
        mean["y"].alias("mean_y"),
        spread("x", "x").alias("sxx"),
        spread("y", "y").alias("syy"),
        spread("x", "y").alias("sxy"),
    ]
