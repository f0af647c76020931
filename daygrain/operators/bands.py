"""Cutting long series by value: bands that hold about equally many rows, and running counts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.operators.joins import broadcast_if_small
from daygrain.operators.series import before, meet, running, whole
from daygrain.session import written

BANDS = 64
#: A row of cuts is a key and ``BANDS`` doubles, so this many are roughly 10 MB.
BROADCAST_CUTS = 20_000


def value_bands(df: DataFrame, series: str, value: str, bands: int = BANDS) -> DataFrame:
    """(series, _cuts, _n): values that cut each series into bands, and its number of rows.

    The cuts are approximate quantiles, from sketches that are merged before and after
    the shuffle. They are written once, because a second computation might cut
    elsewhere. Where the cuts lie changes no result, only how even the bands are.
    """
    shares = F.array(*[F.lit(i / bands) for i in range(1, bands)])
    cuts = df.groupBy(series).agg(
        F.coalesce(F.array_distinct(F.percentile_approx(value, shares, F.lit(20 * bands))), F.array().cast("array<double>"))
        .alias("_cuts"),
        F.count(F.lit(1)).alias("_n"),
    )
    return written(cuts, "cuts")


def with_band(df: DataFrame, cuts: DataFrame, series: str, value: str) -> DataFrame:
    """Rows with ``_n`` and ``_band``, the number of cuts below the value; NULL is past all.

    Equal values share a band. Few cuts are broadcast; many meet the rows in a shuffle
    that adaptive execution may split.
    """
    rows = meet(df, broadcast_if_small(cuts, BROADCAST_CUTS), [series])
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    past = F.size("_cuts") + 1
    return rows.withColumn("_band", F.when(F.col(value).isNull(), past).otherwise(below)).drop("_cuts")


def rows_below(per_band: DataFrame, series: str) -> DataFrame:
    """(series, _band, _below) from counts ``n`` per band."""
    below = F.coalesce(F.sum("n").over(before(series, "_band")), F.lit(0))
    return per_band.select(series, "_band", below.alias("_below"))


def value_counts(df: DataFrame, series: str, value: str) -> DataFrame:
    """(series, value, n, _up_to, _n): how often each value occurs, rows up to it, and rows of the series.

    NULL is the last value. The table is counted in one pass over the rows, cut into bands,
    added up inside them and written, so that cuts, ranks and quartiles all come from it and
    long series are spread over tasks.
    """
    values = written(df.groupBy(series, value).agg(F.count(F.lit(1)).alias("n")), "values")
    banded = with_band(values, value_bands(values, series, value), series, value).drop("_n")
    per_band = banded.groupBy(series, "_band").agg(F.sum("n").alias("n"))
    # A series has a row per band here.
    per_band = per_band.withColumn("_n", F.sum("n").over(whole(series)))
    totals = meet(per_band.select(series, "_band", "_n"), rows_below(per_band, series), [series, "_band"])
    up_to = F.col("_below") + F.sum("n").over(running([series, "_band"], value))
    counted = meet(banded, totals, [series, "_band"]).withColumn("_up_to", up_to)
    return written(counted.select(series, value, "n", "_up_to", "_n"), "value-counts")
