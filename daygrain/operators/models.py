"""The four model tables: rolling averages, anomalies, rolling rain, dry spells.

Each takes and returns a DataFrame and is lazy. No global sort: order is asked for
where rows are shown, and files are sorted when written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.functions import (
    anomaly_category,
    dry_spell_label,
    flag,
    period_label,
    round_half_up,
)
from daygrain.operators.joins import attach_series_stats
from daygrain.operators.series import (
    before,
    block_number,
    meet,
    ordered,
    rows_back,
    running,
    with_preceding_rows,
)

TEMPERATURES = ("temp_max", "temp_min", "temp_mean")


def moving_avg(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    window: int = 7,
    block_days: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Rolling averages of the three temperatures over ``window`` rows.

    Rows that lack any of the three are left out before the frames are built.
    ``before`` holds the last ``window`` - 1 such rows of each series before those of
    ``df`` (see :mod:`daygrain.operators.carry`); they fill frames and are not returned.
    """
    complete = F.lit(True)
    for c in TEMPERATURES:
        complete = complete & F.col(c).isNotNull()
    # Written as separate NOT NULL tests, which the Parquet scan takes over.
    rows = df.select(
        series, time, *TEMPERATURES, "precipitation_mm", "wind_speed_max_kmh"
    ).filter(complete)
    rows, keys = with_preceding_rows(rows, series, time, window - 1, block_days)
    rows = _after(before, rows, block_days)
    frame = rows_back(keys, time, window - 1)
    averaged = rows.select(
        "*",
        *[F.avg(c).over(frame).alias(f"_avg_{c}") for c in TEMPERATURES],
        F.count(F.lit(1)).over(frame).alias("rolling_window_days"),
    ).filter(~F.col("_copy"))
    return averaged.select(
        series,
        time,
        *TEMPERATURES,
        "precipitation_mm",
        "wind_speed_max_kmh",
        *[round_half_up(f"_avg_{c}", 2).alias(f"{c}_{window}day_avg") for c in TEMPERATURES],
        "rolling_window_days",
    )


def _after(before: DataFrame | None, rows: DataFrame, block_days: int | None) -> DataFrame:
    """Rows with those that only fill their frames."""
    if before is None:
        return rows
    if block_days:
        raise ValueError("rows before a table are for plans without blocks")
    return rows.unionByName(before.withColumn("_copy", F.lit(True)), allowMissingColumns=True)


def temp_anomaly(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    band: float = 2.0,
    block_days: int | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Difference of each day from its series' average.

    The average is rounded first and then subtracted; the category tests the
    unrounded difference. A missing maximum drops a row, and so does a missing series,
    which meets no average.
    """
    rows = df.select(series, time, *TEMPERATURES).filter(
        F.col("temp_max").isNotNull() & F.col(series).isNotNull()
    )
    averages = {f"avg_{c}": F.avg(c) for c in TEMPERATURES}
    rows = attach_series_stats(rows, series, averages, time, block_days, max_broadcast_rows)
    rows = rows.select(
        series,
        time,
        *TEMPERATURES,
        *[round_half_up(f"avg_{c}", 2).alias(f"avg_{c}") for c in TEMPERATURES],
    )
    difference = {c: F.col(c) - F.col(f"avg_{c}") for c in TEMPERATURES}
    return rows.select(
        "*",
        *[round_half_up(difference[c], 2).alias(f"{c}_anomaly") for c in TEMPERATURES],
        anomaly_category(difference["temp_max"], band).alias("anomaly_category"),
    )


def rolling_precip(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    short: int = 7,
    long: int = 30,
    wet_mm: float = 25.0,
    block_days: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Rolling rain totals over ``short`` and ``long`` rows, and a period label.

    ``before``: as in :func:`moving_avg`, the last ``long`` - 1 rows with an amount.
    """
    rows = df.select(
        series, time, "precipitation_mm", "temp_max", "temp_min", "weather_code"
    ).filter(F.col("precipitation_mm").isNotNull())
    rows, keys = with_preceding_rows(rows, series, time, long - 1, block_days)
    rows = _after(before, rows, block_days)
    near = rows_back(keys, time, short - 1)
    far = rows_back(keys, time, long - 1)
    rain_day = flag(F.col("precipitation_mm") > 0)
    summed = rows.select(
        "*",
        rain_day.alias("is_rain_day"),
        F.sum("precipitation_mm").over(near).alias("_near"),
        F.sum(rain_day).over(near).alias(f"rain_days_last_{short}"),
        F.sum("precipitation_mm").over(far).alias("_far"),
    ).filter(~F.col("_copy"))
    return summed.select(
        series,
        time,
        "precipitation_mm",
        "temp_max",
        "temp_min",
        "weather_code",
        "is_rain_day",
        round_half_up("_near", 2).alias(f"precip_{short}day_rolling_sum"),
        f"rain_days_last_{short}",
        round_half_up("_far", 2).alias(f"precip_{long}day_rolling_sum"),
        period_label(F.col("_near"), wet_mm).alias("period_label"),
    )


def dry_spell(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    anchor: str = "coded",
    block_days: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Consecutive dry days up to each day, and the longest run so far.

    ``anchor="coded"`` counts a dry run from the rain day that opened it, so the
    first dry day after rain is day 2; a run before any rain starts at 1.
    ``anchor="documented"`` starts every run at 1. Rain days count 0.

    A run's length is the distance in rows from the last rain day, so position,
    last rain position and running maximum share one shuffle and one sort.

    ``before`` holds, per series, the dry days that reach into ``df`` and the longest run
    before it (dry_days, longest), counted with the same anchor.
    """
    opening_day = opening(anchor)
    if before is not None and block_days:
        raise ValueError("rows before a table are for plans without blocks")

    columns = [series, time, "precipitation_mm", "temp_max", "weather_code"]
    rows = df.select(*columns).filter(F.col("precipitation_mm").isNotNull())
    rain = F.col("precipitation_mm") > 0
    keys = [series]
    if block_days:
        rows = rows.withColumn("_block", block_number(time, block_days))
        keys = [series, "_block"]

    rows = rows.withColumn("_row", F.row_number().over(ordered(keys, time)).cast("bigint"))
    rows = rows.withColumn("_rain_row", F.max(F.when(rain, F.col("_row"))).over(running(keys, time)))
    since_rain = F.col("_row") - F.col("_rain_row") + opening_day
    # NULL until the first rain day of the group; rain days count 0.
    rows = rows.withColumn("_days", F.when(rain, F.lit(0)).otherwise(since_rain).cast("bigint"))

    carried, longest_before = F.lit(0), F.lit(0)
    if block_days:
        rows = meet(rows, _dry_spell_carry(rows, series, opening_day), keys)
        carried, longest_before = F.col("_carried"), F.col("_longest_before")
    elif before is not None:
        state = before.select(series, F.col("dry_days").alias("_carried"), F.col("longest").alias("_longest_before"))
        rows = meet(rows, state, [series], "left")
        carried, longest_before = F.coalesce("_carried", F.lit(0)), F.coalesce("_longest_before", F.lit(0))

    days = F.coalesce("_days", F.col("_row") + carried).cast("bigint")
    rows = rows.withColumn("dry_spell_days", days)
    longest = F.greatest(F.max("dry_spell_days").over(running(keys, time)), longest_before)
    return rows.select(
        *columns,
        flag(rain).alias("is_rain_day"),
        "dry_spell_days",
        dry_spell_label(F.col("dry_spell_days")).alias("dry_spell_label"),
        longest.cast("bigint").alias("max_dry_spell_so_far"),
    )


def opening(anchor: str) -> int:
    """The number of dry days that a rain day opens a run with."""
    if anchor not in ("coded", "documented"):
        raise ValueError(f"anchor must be 'coded' or 'documented', not {anchor!r}")
    return 1 if anchor == "coded" else 0


def _dry_spell_carry(rows: DataFrame, series: str, opening_day: int) -> DataFrame:
    """Dry days that reach into each block, and the longest run before it.

    One row per series and block, computed from per-block counts alone.
    """
    rain_row = F.when(F.col("precipitation_mm") > 0, F.col("_row"))
    blocks = rows.groupBy(series, "_block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(rain_row).alias("first_rain"),
        F.max(rain_row).alias("last_rain"),
        F.max("_days").alias("longest_inside"),
    )
    earlier = before(series, "_block")
    blocks = blocks.withColumn("rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = blocks.withColumn(
        "rain_before", F.max(F.col("rows_before") + F.col("last_rain")).over(earlier)
    )
    carried: Column = F.coalesce(
        F.col("rows_before") - F.col("rain_before") + opening_day, F.col("rows_before")
    )
    leading = F.coalesce(F.col("first_rain") - 1, F.col("n"))
    blocks = blocks.withColumn("_carried", carried).withColumn(
        "longest", F.greatest(F.when(leading > 0, F.col("_carried") + leading), "longest_inside")
    )
    return blocks.select(
        series,
        "_block",
        "_carried",
        F.coalesce(F.max("longest").over(earlier), F.lit(0)).alias("_longest_before"),
    )
