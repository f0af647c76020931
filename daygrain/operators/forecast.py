"""Trend forecasts: one straight line per series, fitted by aggregation.

A fitted model is a DataFrame with one row per series that holds the moments of
(day, value). Fitting is one partial aggregation, so a long series is reduced
where it lies and only one row per series and task is shuffled.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions import clean_label, round_half_up
from daygrain.operators import moments

#: Label of the single series when no series column is given.
SINGLE_SERIES = "all"

_MOMENTS = moments.MOMENTS

# Why a series has no line or no metrics.
NO_VALUES = "no values"
TOO_FEW = "too few rows"
ONE_DAY = "one day"
TOO_FEW_BEFORE = "too few before the holdout"


def training_set(
    df: DataFrame, series: str = "city", time: str = "date", target: str = "temp_max"
) -> DataFrame:
    """The columns a model needs, without missing targets."""
    return df.select(series, time, target).filter(F.col(target).isNotNull())


def _moments(target: str, time: str) -> list[Column]:
    x = F.unix_date(F.col(time)).cast("double")
    y = F.col(target)
    return [
        F.count(y).alias("n"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_avgy(y, x).alias("mean_y"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.max(time).alias("last_day"),
    ]


def _usable(model: DataFrame, min_obs: int, on_error: str) -> DataFrame:
    """Drop the series no line can be fitted to, or raise on them."""
    good = (F.col("n") >= min_obs) & (F.col("sxx") > 0)
    if on_error == "skip":
        return model.filter(good)
    if on_error == "raise":
        message = F.concat(F.lit("cannot fit series "), F.col("series"))
        checked = F.when(F.coalesce(good, F.lit(False)), F.col("n")).otherwise(
            F.raise_error(message).cast("bigint")
        )
        return model.withColumn("n", checked)
    raise ValueError(f"on_error must be 'skip' or 'raise', not {on_error!r}")


def _with_line(model: DataFrame) -> DataFrame:
    slope = F.try_divide("sxy", "sxx")
    residual = F.col("syy") - F.col("sxy") * slope
    variance = F.try_divide(F.greatest(residual, F.lit(0.0)), F.col("n") - 2)
    return model.withColumn("slope", slope).withColumn("variance", variance)


def fit_trend(
    df: DataFrame,
    series: str | None = "city",
    time: str = "date",
    target: str = "temp_max",
    min_obs: int = 10,
    on_error: str = "skip",
) -> DataFrame:
    """Least-squares line of the target over the day, per series.

    With ``series=None`` the table is one series; values of the same day are
    averaged first. ``min_obs`` must be at least 3.
    """
    if min_obs < 3:
        raise ValueError("min_obs must be at least 3")
    observed = df.filter(F.col(target).isNotNull())
    if series is None:
        daily = observed.groupBy(time).agg(F.avg(target).alias(target))
        model = daily.agg(*_moments(target, time)).select(F.lit(SINGLE_SERIES).alias("series"), "*")
    else:
        model = observed.groupBy(F.col(series).alias("series")).agg(*_moments(target, time))
    return _with_line(_usable(model, min_obs, on_error))


def _half_width(x: Column, level: float) -> Column:
    """Half the prediction interval at day number ``x``."""
    z = NormalDist().inv_cdf((1 + level) / 2)
    distance = x - F.col("mean_x")
    spread = 1 + 1 / F.col("n") + distance * distance / F.col("sxx")
    return F.lit(z) * F.sqrt(F.col("variance") * spread)


def _line_at(x: Column) -> Column:
    return F.col("mean_y") + F.col("slope") * (x - F.col("mean_x"))


def predict(
    model: DataFrame, periods: int = 7, level: float = 0.95, quote_labels: bool = False
) -> DataFrame:
    """The next ``periods`` days of each series with a prediction interval.

    A narrow operation on the model. ``quote_labels`` puts double quotes around
    the series label, as some forecast services do.
    """
    label = F.concat(F.lit('"'), "series", F.lit('"')) if quote_labels else F.col("series")
    steps = model.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    day = F.date_add("last_day", F.col("step"))
    x = F.unix_date(day).cast("double")
    return steps.select(
        label.alias("series"),
        day.cast("timestamp_ntz").alias("ts"),
        _line_at(x).alias("forecast"),
        (_line_at(x) - _half_width(x, level)).alias("lower_bound"),
        (_line_at(x) + _half_width(x, level)).alias("upper_bound"),
    )


def _without(total: str, part: str) -> list[Column]:
    """Moments of a series without a part of it, from the moments of both."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    n = col(total, "n") - col(part, "n")
    left = F.when(n > 0, n)

    def mean(axis: str) -> Column:
        whole = col(total, "n") * col(total, f"mean_{axis}")
        return (whole - col(part, "n") * col(part, f"mean_{axis}")) / left

    def product(a: str, b: str) -> Column:
        between = (mean(a) - col(part, f"mean_{a}")) * (mean(b) - col(part, f"mean_{b}"))
        weight = left * col(part, "n") / col(total, "n")
        return col(total, f"s{a}{b}") - col(part, f"s{a}{b}") - weight * between

    return [
        n.alias("n"),
        mean("x").alias("mean_x"),
        mean("y").alias("mean_y"),
        product("x", "x").alias("sxx"),
        product("y", "y").alias("syy"),
        product("x", "y").alias("sxy"),
    ]


def evaluate(
    df: DataFrame,
    series: str = "city",
    time: str = "date",
    target: str = "temp_max",
    holdout: int = 7,
    level: float = 0.95,
    min_obs: int = 10,
) -> DataFrame:
    """Holdout metrics in long form: (series, error_metric, metric_value).

    The last ``holdout`` rows of each series are scored with a line fitted to the
    rows before them. The fit takes the moments of the whole series and removes
    those of the holdout, so no row of the history is shuffled: the whole is a
    partial aggregation, and the newest rows are cut down within each task first.

    MAE, MSE, MAPE (a share; zero actuals left out), SMAPE (0 to 2) and COVERAGE,
    the share of holdout rows inside the interval.
    """
    observed = df.select(F.col(series).alias("series"), time, target).filter(
        F.col(target).isNotNull()
    )
    newest = W.partitionBy("series").orderBy(F.col(time).desc())
    tail = observed.withColumn("_age", F.row_number().over(newest)).filter(
        F.col("_age") <= holdout
    )
    total = observed.groupBy("series").agg(*_moments(target, time))
    scored_days = F.collect_list(F.struct(F.unix_date(time).cast("double").alias("x"), F.col(target).alias("y")))
    held_out = tail.groupBy("series").agg(*_moments(target, time), scored_days.alias("points"))

    joined = total.alias("a").join(held_out.alias("h"), "series")
    return _scores(joined.select("series", *_without("a", "h"), "points"), level, min_obs)


def _scores(head: DataFrame, level: float, min_obs: int) -> DataFrame:
    """Metrics of the ``points`` under the line that the moments of the rows before them give."""
    model = _with_line(_usable(head, min_obs, "skip"))
    points = model.select(
        "series", *_MOMENTS, "slope", "variance", F.inline("points")
    )
    return scored(points, _line_at(F.col("x")), _half_width(F.col("x"), level))


def scored(points: DataFrame, predicted: Column, half_width: Column) -> DataFrame:
    """Metrics in long form of points (series, x, y) under a prediction and half its interval."""
    actual = F.col("y")
    error = F.abs(actual - predicted)
    inside = error <= half_width
    size = F.abs(actual) + F.abs(predicted)
    metrics = points.groupBy("series").agg(
        F.avg(error).alias("MAE"),
        F.avg(error * error).alias("MSE"),
        F.avg(F.when(actual != 0, error / F.abs(actual))).alias("MAPE"),
        F.avg(F.when(size > 0, 2 * error / size).otherwise(F.lit(0.0))).alias("SMAPE"),
        F.avg(inside.cast("double")).alias("COVERAGE"),
    )
    return metrics.unpivot(
        ["series"], ["MAE", "MSE", "MAPE", "SMAPE", "COVERAGE"], "error_metric", "metric_value"
    )


def fit_moments(per_month: DataFrame, min_obs: int = 10, on_error: str = "skip") -> DataFrame:
    """The model of :func:`fit_trend` from the moments of series and months, without a row of the table."""
    return _with_line(_usable(moments.merged(per_month), min_obs, on_error))


def _heads(per_month: DataFrame, holdout: int) -> DataFrame:
    """Per series the moments of all values (struct a), of the holdout (struct h), and the holdout's points."""
    if holdout > moments.POINTS:
        raise ValueError(f"months keep {moments.POINTS} points, too few for a holdout of {holdout}")
    whole = moments.merged(per_month).withColumn("points", F.slice("points", 1, holdout))
    return whole.select(
        "series", "n_rows", F.struct(*_MOMENTS).alias("a"), F.struct(*moments.of_points("points")).alias("h"), "points"
    )


def evaluate_moments(
    per_month: DataFrame, holdout: int = 7, level: float = 0.95, min_obs: int = 10
) -> DataFrame:
    """The metrics of :func:`evaluate` from the moments of series and months."""
    return _scores(_heads(per_month, holdout).select("series", *_without("a", "h"), "points"), level, min_obs)


def fit_outcomes(per_month: DataFrame, holdout: int = 7, min_obs: int = 10) -> DataFrame:
    """What becomes of every series: fitted or skipped, scored or skipped, and why.

    Series without any value are listed too. ``n_rows`` counts rows, ``n`` values; ``sxx`` is
    the spread of their days, 0 where all values are of one day.
    """
    heads = _heads(per_month, holdout)
    before = heads.select("series", "n_rows", "a", F.struct(*_without("a", "h")).alias("head"))

    def reason(part: str, few: str) -> Column:
        n, spread = F.col(f"{part}.n"), F.col(f"{part}.sxx")
        return F.when(n < min_obs, few).when(~F.coalesce(spread > 0, F.lit(False)), ONE_DAY)

    fit_reason = F.when(F.col("a.n") == 0, NO_VALUES).otherwise(reason("a", TOO_FEW))
    return before.select(
        "series",
        "n_rows",
        F.col("a.n").alias("n"),
        F.col("a.sxx").alias("sxx"),
        fit_reason.isNull().alias("fitted"),
        fit_reason.alias("fit_reason"),
        (fit_reason.isNull() & reason("head", TOO_FEW_BEFORE).isNull()).alias("scored"),
        F.coalesce(fit_reason, reason("head", TOO_FEW_BEFORE)).alias("score_reason"),
    )


def latest_run(metrics: DataFrame) -> DataFrame:
    """Metrics of the newest run only."""
    newest = metrics.agg(F.max("run_ts")).scalar()
    return metrics.filter(F.col("run_ts") == newest).select(
        F.col("series").alias("city"), "error_metric", "metric_value", "run_ts"
    )


def final_series(
    actuals: DataFrame,
    forecast: DataFrame,
    series: str = "city",
    time: str = "date",
    target: str = "temp_max",
) -> DataFrame:
    """Actuals and forecasts in one table; each side leaves the other's columns NULL."""
    absent = F.lit(None).cast("double")
    past = actuals.select(
        F.col(series).alias("city"),
        F.col(time).alias("date"),
        F.col(target).alias("actual"),
        absent.alias("forecast"),
        absent.alias("lower_bound"),
        absent.alias("upper_bound"),
    )
    future = forecast.select(
        clean_label("series").alias("city"),
        F.col("ts").cast("date").alias("date"),
        absent.alias("actual"),
        "forecast",
        "lower_bound",
        "upper_bound",
    )
    return past.unionByName(future)


def uncertainty(forecast: DataFrame) -> DataFrame:
    """Rounded bounds, band width, and the rank of each day by width.

    A forecast has a fixed number of rows per series, so the window is small.
    """
    width = F.col("upper_bound") - F.col("lower_bound")
    bands = forecast.withColumn("city", clean_label("series")).withColumn("_width", width)
    widest = W.partitionBy("city").orderBy(F.col("_width").desc_nulls_first())
    return bands.select(
        "city",
        F.col("ts").alias("forecast_date"),
        round_half_up("forecast", 2).alias("predicted_temp"),
        round_half_up("lower_bound", 2).alias("lower_95"),
        round_half_up("upper_bound", 2).alias("upper_95"),
        round_half_up("_width", 2).alias("confidence_band_width"),
        F.rank().over(widest).cast("bigint").alias("uncertainty_rank"),
    )
