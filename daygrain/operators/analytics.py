"""Analytic queries over the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions import (
    decode_code,
    flag,
    quartile_label,
    round_half_up,
    sigma_flag,
)
from daygrain.operators.bands import value_counts
from daygrain.operators.joins import attach_series_stats
from daygrain.operators.series import (
    before,
    block_number,
    meet,
    rows_back,
    running,
    with_preceding_rows,
)


def trend_deviation(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    value: str = "temp_max",
    short: int = 7,
    long: int = 14,
    block_days: int | None = None,
) -> DataFrame:
    """Two rolling averages and the distance from the unrounded shorter one."""
    rows, keys = with_preceding_rows(
        df.select(series, time, value), series, time, long - 1, block_days
    )
    near = F.avg(value).over(rows_back(keys, time, short - 1))
    far = F.avg(value).over(rows_back(keys, time, long - 1))
    averaged = rows.select("*", near.alias("_near"), far.alias("_far")).filter(~F.col("_copy"))
    return averaged.select(
        series,
        time,
        value,
        round_half_up("_near", 2).alias(f"rolling_{short}day_avg"),
        round_half_up("_far", 2).alias(f"rolling_{long}day_avg"),
        round_half_up(F.col(value) - F.col("_near"), 2).alias(f"deviation_from_{short}day_trend"),
    )


def sigma_flags(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    value: str = "temp_max",
    k: float = 2.0,
    block_days: int | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Flag days more than ``k`` sample standard deviations from the series mean.

    Rows without a value, and series of one row, are normal.
    """
    stats = {"_avg": F.avg(value), "_stddev": F.stddev_samp(value)}
    rows = attach_series_stats(
        df.select(series, time, value), series, stats, time, block_days, max_broadcast_rows
    )
    return rows.select(
        series,
        time,
        value,
        round_half_up("_avg", 2).alias("city_avg"),
        round_half_up("_stddev", 2).alias("city_stddev"),
        round_half_up(F.col(value) - F.col("_avg"), 2).alias("deviation"),
        sigma_flag(F.col(value), F.col("_avg"), F.col("_stddev"), k).alias("anomaly_flag"),
    )


def temp_ranks(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    value: str = "temp_max",
    block_days: int | None = None,
) -> DataFrame:
    """Percent rank and quartile of each day within its series.

    Missing values sort last. The day breaks ties for the quartile only: equal
    values share a percent rank. With ``block_days`` a series is cut into bands
    of values rather than days, see :func:`daygrain.operators.bands.value_counts`; that
    counts the values of a series in one pass at once, and reads the rows once more.
    """
    rows = df.select(series, time, "temp_max", "temp_min")
    if block_days:
        ranked = _ranks_in_bands(rows, series, time, value)
    else:
        by_value = W.partitionBy(series).orderBy(F.col(value).asc_nulls_last())
        by_value_and_day = by_value.orderBy(F.col(value).asc_nulls_last(), F.col(time).asc())
        ranked = rows.select(
            "*",
            F.ntile(4).over(by_value_and_day).cast("bigint").alias("temp_quartile"),
            F.percent_rank().over(by_value).alias("_rank"),
        )
    return ranked.select(
        series,
        time,
        "temp_max",
        "temp_min",
        round_half_up("_rank", 3).alias("temp_percentile"),
        "temp_quartile",
        quartile_label(F.col("temp_quartile")).alias("temp_category"),
    )


def _ranks_in_bands(rows: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """Ranks from running counts over the distinct values; the day counts among equal values only."""
    counts = value_counts(rows, series, value)
    same = W.partitionBy(series, value).orderBy(F.col(time).asc())
    smaller = F.col("_up_to") - F.col("n")
    rows = meet(rows, counts, [series, value]).select(
        *rows.columns, "_n", smaller.alias("_smaller"), (smaller + F.row_number().over(same) - 1).alias("_index")
    )
    # The first n % 4 quarters hold one row more than the others.
    small = F.floor(F.col("_n") / 4)
    surplus = F.col("_n") % 4
    in_large = surplus * (small + 1)
    quarter = F.when(
        F.col("_index") < in_large, F.floor(F.col("_index") / (small + 1))
    ).otherwise(surplus + F.floor((F.col("_index") - in_large) / F.when(small > 0, small)))
    share = F.when(F.col("_n") > 1, F.col("_smaller") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return rows.select(
        "*", (quarter + 1).cast("bigint").alias("temp_quartile"), share.alias("_rank")
    )


def rain_streaks(
    df: DataFrame, series: str = "city", time: str = "date", block_days: int | None = None
) -> DataFrame:
    """Runs of consecutive rainy rows: start, end, length and total rain.

    Within a run the row number minus the count of rainy rows so far stays the
    same; that difference, the dry rows so far, names the run. A missing amount
    is a dry row. The rows are aggregated where the window left them.
    """
    rows = df.select(series, time, "precipitation_mm").withColumn(
        "_dry", 1 - flag(F.col("precipitation_mm") > 0)
    )
    keys = [series]
    offset = F.lit(0)
    if block_days:
        rows = rows.withColumn("_block", block_number(time, block_days))
        keys = [series, "_block"]
        per_block = rows.groupBy(*keys).agg(F.sum("_dry").alias("n_dry"))
        carry = per_block.select(
            *keys,
            F.coalesce(F.sum("n_dry").over(before(series, "_block")), F.lit(0)).alias("_offset"),
        )
        rows = meet(rows, carry, keys)
        offset = F.col("_offset")
    run = (F.sum("_dry").over(running(keys, time)) + offset).alias("_run")
    return (
        rows.select(series, time, "precipitation_mm", "_dry", run)
        .filter(F.col("_dry") == 0)
        .groupBy(series, "_run")
        .agg(
            F.min(time).alias("streak_start"),
            F.max(time).alias("streak_end"),
            F.count(F.lit(1)).alias("streak_length_days"),
            round_half_up(F.sum("precipitation_mm"), 1).alias("total_rain_mm"),
        )
        .drop("_run")
    )


def longest_rain_streaks(
    df: DataFrame,
    n: int = 10,
    series: str = "city",
    time: str = "date",
    block_days: int | None = None,
) -> DataFrame:
    """The ``n`` longest runs of rainy rows; ties go by series and start."""
    return (
        rain_streaks(df, series, time, block_days)
        .orderBy(F.desc("streak_length_days"), F.asc(series), F.asc("streak_start"))
        .limit(n)
    )


def compare_series(
    df: DataFrame,
    names: Sequence[str],
    differences: Sequence[tuple[int, int]] = ((0, 1), (0, 3), (2, 3)),
    series: str = "city",
    time: str = "date",
    value: str = "temp_max",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """Values of several series side by side, for the days all of them have.

    Equals an inner self-join on the day with one series per side, because
    (series, day) is unique; it reads the table once and pre-aggregates by day.
    """
    labels = list(labels) if labels else [f"s{i}" for i in range(len(names))]
    sides = [F.col(series) == name for name in names]
    by_day = (
        df.filter(F.col(series).isin(*names))
        .groupBy(time)
        .agg(
            *[F.max(F.when(s, F.col(value))).alias(f"{c}_temp") for s, c in zip(sides, labels)],
            *[F.count(F.when(s, F.lit(1))).alias(f"_n{i}") for i, s in enumerate(sides)],
        )
    )
    everywhere = F.lit(True)
    for i in range(len(names)):
        everywhere = everywhere & (F.col(f"_n{i}") > 0)
    return by_day.filter(everywhere).select(
        time,
        *[f"{c}_temp" for c in labels],
        *[
            round_half_up(F.col(f"{labels[a]}_temp") - F.col(f"{labels[b]}_temp"), 1).alias(
                f"{labels[a]}_vs_{labels[b]}"
            )
            for a, b in differences
        ],
    )


def weather_descriptions(df: DataFrame, code: str = "weather_code") -> DataFrame:
    """All columns plus the description of the weather code."""
    return df.withColumn("weather_description", decode_code(code))


def recent_loads(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rows loaded last; ties go by key."""
    return (
        df.select("city", "date", "load_ts")
        .orderBy(F.col("load_ts").desc_nulls_first(), F.asc("city"), F.asc("date"))
        .limit(n)
    )


def loaded_since(df: DataFrame, moment: str) -> DataFrame:
    """Rows loaded after a moment, by series and newest day first."""
    later = F.col("load_ts") > F.lit(moment).cast("timestamp_ntz")
    return df.filter(later).orderBy(F.asc("city"), F.desc("date"))


def last_days(df: DataFrame, name: str, n: int = 5) -> DataFrame:
    """The ``n`` newest days of one series."""
    return (
        df.filter(F.col("city") == name)
        .select(
            "city",
            "date",
            "temp_max",
            "temp_min",
            "temp_mean",
            "precipitation_mm",
            "wind_speed_max_kmh",
            "weather_code",
        )
        .orderBy(F.desc("date"))
        .limit(n)
    )


def sorted_for_display(df: DataFrame, **direction: str) -> DataFrame:
    """Sort a result for reading, for example ``city="asc", date="desc"``.

    NULLs come last ascending and first descending. Use it on results that are
    shown; stored tables are sorted within files instead.
    """
    order = [
        F.col(c).asc_nulls_last() if d == "asc" else F.col(c).desc_nulls_first()
        for c, d in direction.items()
    ]
    return df.orderBy(*order)
