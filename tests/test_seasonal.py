"""The seasonal forecast against the line, against numpy, and on series that have no season to learn."""

from __future__ import annotations

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrain.operators.forecast import evaluate, fit_trend, predict
from daygrain.operators.seasonal import evaluate_seasonal, forecast_seasonal
from daygrain.sources.bindings import daily_ship

SCHEMA = "city string, date date, temp_max double"


def cycle(city, days, seed, start="2021-03-01"):
    rng = random.Random(seed)
    first = datetime.date.fromisoformat(start)
    rows = []
    for i in range(days):
        day = first + datetime.timedelta(days=i)
        warm = 15 + 10 * math.cos(2 * math.pi * (day.timetuple().tm_yday - 200) / 365.25) + 0.001 * i
        rows.append((city, day, warm + rng.gauss(0, 1.5)))
    return rows


def mean_error(metrics):
    return metrics.filter("error_metric = 'MAE'").agg(F.avg("metric_value")).first()[0]


def test_a_season_is_better_than_a_line(spark, data_dir):
    df = spark.createDataFrame([r for s in range(8) for r in cycle(f"c{s}", 500 + 90 * s, s)], SCHEMA)
    assert mean_error(evaluate_seasonal(df)) < 0.5 * mean_error(evaluate(df))
    inside = evaluate_seasonal(df).filter("error_metric = 'COVERAGE'").agg(F.avg("metric_value")).first()[0]
    assert inside > 0.8
    # Where there is no season, looking for one costs next to nothing.
    ship = daily_ship(spark, data_dir)
    assert mean_error(evaluate_seasonal(ship)) <= 1.02 * mean_error(evaluate(ship))


@pytest.mark.parametrize("harmonics", [1, 2])
def test_equal_to_numpy(spark, harmonics):
    rows = cycle("A", 800, 1)
    got = forecast_seasonal(spark.createDataFrame(rows, SCHEMA), harmonics=harmonics).orderBy("ts").collect()
    day = np.array([r[1].toordinal() - datetime.date(2000, 1, 1).toordinal() for r in rows]) / 365.25
    features = lambda t: np.column_stack(
        [np.ones_like(t), t] + [g(2 * np.pi * k * t) for k in range(1, harmonics + 1) for g in (np.cos, np.sin)]
    )
    x, y = features(day), np.array([r[2] for r in rows])
    beta, residual, *_ = np.linalg.lstsq(x, y, rcond=None)
    ahead = features(day[-1] + np.arange(1, 8) / 365.25)
    spread = np.sqrt(residual[0] / (len(y) - x.shape[1]) * (1 + np.einsum("ij,jk,ik->i", ahead, np.linalg.inv(x.T @ x), ahead)))
    assert np.allclose([r.forecast for r in got], ahead @ beta)
    assert np.allclose([(r.upper_bound - r.lower_bound) / 2 for r in got], 1.959963984540054 * spread)


def test_short_series_get_the_line(spark):
    df = spark.createDataFrame(cycle("short", 200, 1) + cycle("few", 5, 2) + [("none", datetime.date(2024, 1, 1), None)], SCHEMA)
    line = {r.ts: r for r in predict(fit_trend(df)).collect()}
    got = forecast_seasonal(df)
    assert got.columns == ["series", "ts", "forecast", "lower_bound", "upper_bound"]
    rows = got.collect()
    assert len(rows) == 7 and {r.series for r in rows} == {"short"}
    for r in rows:
        assert r.forecast == pytest.approx(line[r.ts].forecast) and r.upper_bound == pytest.approx(line[r.ts].upper_bound)
    plain, seasonal = (
        {r.error_metric: r.metric_value for r in f(df).collect()} for f in (evaluate, evaluate_seasonal)
    )
    assert plain == pytest.approx(seasonal)


def test_degenerate_series(spark):
    day = datetime.date(2024, 1, 1)
    same_day = [("one day", day, float(i)) for i in range(20)]
    constant = [("constant", day + datetime.timedelta(days=i), 5.0) for i in range(400)]
    leap = [("yearly", datetime.date(2000 + i, 1, 1), float(i)) for i in range(24)]
    df = spark.createDataFrame(same_day + constant + leap + [(None, day + datetime.timedelta(days=i), 1.0) for i in range(12)], SCHEMA)
    rows = forecast_seasonal(df).collect()
    assert {r.series for r in rows} == {"constant", "yearly", None}
    assert all(abs(r.forecast - 5) < 1e-6 for r in rows if r.series == "constant")
    assert forecast_seasonal(df.limit(0)).count() == 0 and evaluate_seasonal(df.limit(0)).count() == 0
