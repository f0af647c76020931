"""The queries behind the dashboard charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions import round_half_up
from daygrain.operators.bands import value_counts
from daygrain.operators.series import meet, running, whole


def between_days(df: DataFrame, start: str, end: str, time: str = "date") -> DataFrame:
    """The date-range filter of a dashboard; both ends included."""
    return df.filter(F.col(time).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def latest_month(df: DataFrame, time: str = "date") -> DataFrame:
    """Rows of the newest month in the table.

    The newest day is one value, found first; the filter on it is then a plain
    comparison that reaches the scan.
    """
    newest = df.agg(F.trunc(F.max(time), "month")).scalar()
    return df.filter(F.col(time) >= newest)


def climate_profile(df: DataFrame, series: str = "city") -> DataFrame:
    """Average maximum, minimum, rain and wind of each series."""
    return df.groupBy(series).agg(
        round_half_up(F.avg("temp_max"), 2).alias("avg_temp_max"),
        round_half_up(F.avg("temp_min"), 2).alias("avg_temp_min"),
        round_half_up(F.avg("precipitation_mm"), 2).alias("avg_precipitation_mm"),
        round_half_up(F.avg("wind_speed_max_kmh"), 2).alias("avg_wind_speed_max_kmh"),
    )


def rolling_trend(moving_avg: DataFrame) -> DataFrame:
    return moving_avg.select("date", "city", "temp_max_7day_avg")


def temp_wind_profile(df: DataFrame, series: str = "city") -> DataFrame:
    """Average maximum and minimum with the average wind as bubble size."""
    return df.groupBy(series).agg(
        round_half_up(F.avg("temp_max"), 2).alias("avg_temp_max"),
        round_half_up(F.avg("temp_min"), 2).alias("avg_temp_min"),
        round_half_up(F.avg("wind_speed_max_kmh"), 2).alias("avg_wind_speed_max_kmh"),
    )


def max_dry_spell(dry_spell: DataFrame) -> DataFrame:
    return dry_spell.select("date", "city", "max_dry_spell_so_far")


def latest_month_avg(moving_avg: DataFrame) -> DataFrame:
    return latest_month(moving_avg).select("date", "city", "temp_mean_7day_avg")


def anomaly_heatmap(
    temp_anomaly: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Anomaly cells (date, series), optionally for a date range, which may be open at either end.

    The range is applied to the finished model: averages cover all days.
    """
    if start is not None and end is not None:
        temp_anomaly = between_days(temp_anomaly, start, end)
    elif start is not None:
        temp_anomaly = temp_anomaly.filter(F.col("date") >= F.lit(start).cast("date"))
    elif end is not None:
        temp_anomaly = temp_anomaly.filter(F.col("date") <= F.lit(end).cast("date"))
    return temp_anomaly.select("date", "city", "temp_max_anomaly")


def heatmap_matrix(
    cells: DataFrame, value: str = "temp_max_anomaly", tile_digits: int = 1, missing: str = "(none)"
) -> DataFrame:
    """All series of a day side by side: (date, tile, cells), cells a map of series to value.

    A column per series does not scale, and a day of all series has no bound either, so
    a day is cut into ``16 ** tile_digits`` tiles by a digest of the series. A map has no
    NULL key, so the cell of rows without a series has the key ``missing``.
    """
    tile = F.substring(F.md5(F.col("city").cast("binary")), 1, tile_digits)
    entries = F.array_sort(F.collect_list(F.struct("city", value)))
    return (
        cells.withColumn("city", F.coalesce("city", F.lit(missing)))
        .groupBy("date", tile.alias("tile"))
        .agg(F.map_from_entries(entries).alias("cells"))
    )


def avg_rainy_days(rolling_precip: DataFrame, series: str = "city") -> DataFrame:
    return rolling_precip.groupBy(series).agg(
        round_half_up(F.avg(F.col("rain_days_last_7").cast("double")), 2).alias("avg_rain_days")
    )


def rain_temp_points(rolling_precip: DataFrame) -> DataFrame:
    return rolling_precip.filter(F.col("temp_max").isNotNull()).select(
        "city", "date", "precip_7day_rolling_sum", "temp_max"
    )


def rain_temp_relation(points: DataFrame, series: str = "city") -> DataFrame:
    """Correlation and slope of temperature over rolling rain, per series.

    Both are NULL where they are undefined: a series without any variation, for
    instance without rain. (The built-in ``corr`` divides by zero there.)
    """
    y, x = F.col("temp_max"), F.col("precip_7day_rolling_sum")
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return points.groupBy(series).agg(
        F.count(F.lit(1)).alias("n_points"),
        round_half_up(F.try_divide(F.regr_sxy(y, x), spread), 4).alias("correlation"),
        round_half_up(F.regr_slope(y, x), 4).alias("slope"),
    )


_QUARTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def _ends(value: str) -> dict[str, Column]:
    """The values next to each quartile, from running counts over the distinct values."""
    ends = {"min_value": F.min(value), "max_value": F.max(value)}
    for name, share in _QUARTILES:
        place = (F.col("_n") - 1) * F.lit(share)
        for side, at in (("low", F.floor(place)), ("high", F.ceil(place))):
            ends[f"_{name}_{side}"] = F.min(F.when(F.col("_up_to") > at, F.col(value)))
    return ends


def _fences(box: DataFrame) -> DataFrame:
    """Quartiles between their neighbouring values, and the fences."""
    for name, share in _QUARTILES:
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        place = (F.col("_n") - 1) * F.lit(share)
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        box = box.withColumn(name, F.when(low == high, low).otherwise(between))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = box.withColumn("lower_fence", F.col("q1") - reach).withColumn("upper_fence", F.col("q3") + reach)
    return fenced.drop(*[f"_{name}_{side}" for name, _ in _QUARTILES for side in ("low", "high")])


_BOX = ("min_value", "q1", "median", "q3", "max_value", "lower_fence", "upper_fence")


def _box(df: DataFrame, series: str, value: str, block_days: int | None) -> DataFrame:
    """Exact quartiles, fences and number of outliers per series, from one pass over the rows.

    Equal values are counted before they move. A running count over the distinct values tells
    where each quartile lies, and the same values are held against the fences. With
    ``block_days`` the counts are written first, in bands of values.
    """
    kept = df.select(series, value).filter(F.col(value).isNotNull())
    if block_days:
        counted = value_counts(kept, series, value)
        ends = counted.groupBy(series).agg(
            F.first("_n").alias("_n"), *[expr.alias(name) for name, expr in _ends(value).items()]
        )
        fenced = meet(counted.select(series, value, "n"), _fences(ends).drop("_n"), [series])
    else:
        counted = kept.groupBy(series, value).agg(F.count(F.lit(1)).alias("n")).select(
            "*",
            F.sum("n").over(running(series, value)).alias("_up_to"),
            F.sum("n").over(whole(series)).alias("_n"),
        )
        own = whole(series)
        fenced = _fences(counted.select("*", *[expr.over(own).alias(name) for name, expr in _ends(value).items()]))
    outliers = F.coalesce(F.sum(F.when(_outside(value), F.col("n"))), F.lit(0))
    return fenced.groupBy(series).agg(*[F.first(c).alias(c) for c in _BOX], outliers.alias("n_outliers"))


def _outside(value: str) -> Column:
    return (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))


def temp_distribution(
    df: DataFrame,
    series: str = "city",
    value: str = "temp_max",
    block_days: int | None = None,
) -> DataFrame:
    """Box plot of each series: five numbers, fences and number of outliers.

    Exact quartiles. An outlier lies more than 1.5 interquartile ranges outside.
    """
    box = _box(df, series, value, block_days)
    rounded = ("q1", "median", "q3", "lower_fence", "upper_fence")
    return box.select(*[round_half_up(c, 4).alias(c) if c in rounded else F.col(c) for c in box.columns])


def temp_outliers(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    value: str = "temp_max",
    block_days: int | None = None,
) -> DataFrame:
    """The single days that lie outside the box-plot fences of their series."""
    fences = _box(df, series, value, block_days).select(series, "lower_fence", "upper_fence")
    rows = df.select(series, time, value).filter(F.col(value).isNotNull())
    return meet(rows, fences, [series]).filter(_outside(value)).select(series, time, value)


def monthly_averages(df: DataFrame, series: str = "city", time: str = "date") -> DataFrame:
    """Average rain and maximum temperature per month and series, in long form."""
    return df.groupBy(F.trunc(time, "month").alias("month"), series).agg(
        round_half_up(F.avg("precipitation_mm"), 2).alias("avg_precipitation_mm"),
        round_half_up(F.avg("temp_max"), 2).alias("avg_temp_max"),
    )


def monthly_pivot(
    df: DataFrame, months: Sequence[str] | None = None, series: str = "city", time: str = "date"
) -> DataFrame:
    """One row per series and two columns per month (``YYYY-MM``).

    Unless months are given, one job finds those of the table, a list bounded by the
    calendar. Rows without a day belong to no month.
    """
    dated = df.withColumn("month", F.date_format(time, "yyyy-MM"))
    if months is None:
        found = dated.select("month").filter(F.col("month").isNotNull()).distinct()
        months = sorted(r.month for r in found.collect())
    return dated.groupBy(series).pivot("month", list(months)).agg(*_month_values())


def yearly_pivot(df: DataFrame, series: str = "city", time: str = "date") -> DataFrame:
    """One row per series and year and two columns per month (``m01`` to ``m12``).

    Covers the whole table with the same columns however many years there are.
    """
    months = [f"m{m:02d}" for m in range(1, 13)]
    dated = df.withColumn("year", F.year(time).cast("bigint")).withColumn(
        "month", F.concat(F.lit("m"), F.date_format(time, "MM"))
    )
    return dated.groupBy(series, "year").pivot("month", months).agg(*_month_values())


def _month_values() -> list[Column]:
    return [
        round_half_up(F.avg("precipitation_mm"), 2).alias("avg_mm"),
        round_half_up(F.avg("temp_max"), 2).alias("avg_temp"),
    ]
