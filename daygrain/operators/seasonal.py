"""Forecasts with a yearly season: a line and harmonics of the year, by least squares.

The sums of products that least squares needs add up like counts, so a fit is one partial
aggregation per series, and the sums of a series without its last days are those of all days
less those of the last. The equations are solved in column expressions, by the Cholesky factor
L of the matrix of sums: where L z = X'y, and L u = f for the features f of a day, the
forecast is u.z, the residual sum of squares y'y - z.z, and the leverage of the day u.u.

A season can be learned from a year of days. A series that has less than that before the
first day to be forecast, or too few values, gets a line, like the plain forecast: its
harmonics are taken out of the equations.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.operators.forecast import scored

YEAR = 365.25
#: Days are counted in years from here, which keeps the sums of squares small. 2000-01-01.
ORIGIN = 10_957
HARMONICS = 1

#: A share of a sum of squares that rounding may leave.
_SAME = 1e-9
#: Less than the spread of two different days, in years squared, and more than rounding leaves.
_ONE_DAY = 1e-6
#: A pivot by which everything is divided to nothing.
_NO_WEIGHT = 1e150


def _features(x: Column, harmonics: int) -> list[Column]:
    years = (x - F.lit(float(ORIGIN))) / F.lit(YEAR)
    found = [F.lit(1.0), years]
    for k in range(1, harmonics + 1):
        angle = years * F.lit(2 * math.pi * k)
        found += [F.cos(angle), F.sin(angle)]
    return found


def _sums(time: str, target: str, harmonics: int) -> list[Column]:
    """n, yy, s{i}{j} and sy{i}: sums of products of features and values."""
    f, y = _features(F.unix_date(F.col(time)).cast("double"), harmonics), F.col(target)
    pairs = [(i, j) for i in range(len(f)) for j in range(i + 1)]
    return [
        F.count(y).alias("n"),
        F.sum(y * y).alias("yy"),
        *[F.sum(f[i] * f[j]).alias(f"s{i}_{j}") for i, j in pairs],
        *[F.sum(f[i] * y).alias(f"sy{i}") for i in range(len(f))],
    ]


def _solved(sums: DataFrame, harmonics: int, min_obs: int) -> DataFrame:
    """Per series the factor (l{i}_{j}), z, variance and whether it has a season; others are dropped.

    ``sums`` has ``first_day`` and ``next_day``, the first day to be forecast.
    """
    size = 2 + 2 * harmonics
    seasonal = (F.datediff("next_day", "first_day") >= 365) & (F.col("n") >= 2 * size)
    model = sums.filter(F.col("n") >= max(min_obs, 3)).withColumn("season", F.when(seasonal, 1.0).otherwise(0.0))
    on = [F.lit(1.0)] * 2 + [F.col("season")] * (2 * harmonics)
    # Each step is a projection of its own, so that later ones name its result.
    for j in range(size):
        for i in range(j, size):
            own = F.col(f"s{i}_{j}") * on[i] * on[j] + (1 - on[i] if i == j else 0)
            for k in range(j):
                own = own - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            if i > j:
                model = model.withColumn(f"l{i}_{j}", own / F.col(f"l{j}_{j}"))
            else:
                # What the features before it determine, such as a cosine of the same day every
                # year, has nothing but rounding left, and gets no weight.
                left = model.withColumn("left", own)
                free = (F.col("left") > _SAME * F.col(f"s{i}_{i}")) if i > 1 else F.col("left") > _ONE_DAY
                model = left.withColumn(f"l{i}_{i}", F.when(free, F.sqrt("left")).otherwise(F.lit(_NO_WEIGHT)))
        if j == 1:
            # All values of one day: no line, as in the plain forecast.
            model = model.filter(F.col("l1_1") < _NO_WEIGHT)
    for i in range(size):
        own = F.col(f"sy{i}") * on[i]
        for k in range(i):
            own = own - F.col(f"l{i}_{k}") * F.col(f"z{k}")
        model = model.withColumn(f"z{i}", F.try_divide(own, F.col(f"l{i}_{i}")))
    residual = F.col("yy")
    for i in range(size):
        residual = residual - F.col(f"z{i}") * F.col(f"z{i}")
    degrees = F.col("n") - 2 - F.col("season") * (2 * harmonics)
    return model.withColumn("variance", F.greatest(residual, F.lit(0.0)) / degrees)


def _predicted(rows: DataFrame, x: Column, harmonics: int, level: float) -> DataFrame:
    """Rows of a model with ``predicted`` and ``half``, half the prediction interval, at day number ``x``."""
    f = _features(x, harmonics)
    for i in range(len(f)):
        own = f[i] * (F.lit(1.0) if i < 2 else F.col("season"))
        for k in range(i):
            own = own - F.col(f"l{i}_{k}") * F.col(f"u{k}")
        rows = rows.withColumn(f"u{i}", own / F.col(f"l{i}_{i}"))
    value, leverage = F.lit(0.0), F.lit(1.0)
    for i in range(len(f)):
        value = value + F.col(f"u{i}") * F.col(f"z{i}")
        leverage = leverage + F.col(f"u{i}") * F.col(f"u{i}")
    z = NormalDist().inv_cdf((1 + level) / 2)
    return rows.withColumn("predicted", value).withColumn("half", F.lit(z) * F.sqrt(F.col("variance") * leverage))


def forecast_seasonal(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    target: str = "temp_max",
    periods: int = 7,
    level: float = 0.95,
    min_obs: int = 10,
    harmonics: int = HARMONICS,
) -> DataFrame:
    """The next days of each series: the columns of :func:`daygrain.operators.forecast.predict`."""
    observed = df.filter(F.col(target).isNotNull() & F.col(time).isNotNull())
    sums = observed.groupBy(F.col(series).alias("series")).agg(
        *_sums(time, target, harmonics), F.min(time).alias("first_day"), F.max(time).alias("last_day")
    )
    model = _solved(sums.withColumn("next_day", F.date_add("last_day", 1)), harmonics, min_obs)
    steps = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods)))).withColumn(
        "day", F.date_add("last_day", F.col("step"))
    )
    rows = _predicted(steps, F.unix_date("day").cast("double"), harmonics, level)
    return rows.select(
        "series",
        F.col("day").cast("timestamp_ntz").alias("ts"),
        F.col("predicted").alias("forecast"),
        (F.col("predicted") - F.col("half")).alias("lower_bound"),
        (F.col("predicted") + F.col("half")).alias("upper_bound"),
    )


def evaluate_seasonal(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    target: str = "temp_max",
    holdout: int = 7,
    level: float = 0.95,
    min_obs: int = 10,
    harmonics: int = HARMONICS,
) -> DataFrame:
    """Holdout metrics as in :func:`daygrain.operators.forecast.evaluate`.

    The last ``holdout`` rows of a series are cut out within each task before they move, and
    their sums are taken off those of the whole, so no row of the history is shuffled.
    """
    observed = df.select(F.col(series).alias("series"), time, target).filter(
        F.col(target).isNotNull() & F.col(time).isNotNull()
    )
    newest = W.partitionBy("series").orderBy(F.col(time).desc())
    tail = observed.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= holdout)
    sums = _sums(time, target, harmonics)
    total = observed.groupBy("series").agg(*sums, F.min(time).alias("first_day"))
    point = F.struct(F.unix_date(time).cast("double").alias("x"), F.col(target).alias("y"))
    held_out = tail.groupBy("series").agg(
        *sums, F.min(time).alias("next_day"), F.collect_list(point).alias("points")
    )
    names = [c for c in total.columns if c not in ("series", "first_day")]
    head = total.alias("a").join(held_out.alias("h"), "series").select(
        "series",
        *[(F.col(f"a.{c}") - F.col(f"h.{c}")).alias(c) for c in names],
        "first_day",
        "next_day",
        "points",
    )
    model = _solved(head, harmonics, min_obs)
    points = model.select(*[c for c in model.columns if c != "points"], F.inline("points"))
    rows = _predicted(points, F.col("x"), harmonics, level)
    return scored(rows, F.col("predicted"), F.col("half"))
