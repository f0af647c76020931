"""Hand-made tables for the rules that generated data may not reach."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import column
from daygrain.functions import clean_label, decode_code, round_half_up, row_key
from daygrain.operators import checks, dashboard, models
from daygrain.operators.analytics import (
    compare_series,
    last_days,
    longest_rain_streaks,
    rain_streaks,
    recent_loads,
    sigma_flags,
    sorted_for_display,
    temp_ranks,
    trend_deviation,
)
from daygrain.operators.dashboard import (
    anomaly_heatmap,
    between_days,
    heatmap_matrix,
    latest_month,
    monthly_averages,
    monthly_pivot,
    yearly_pivot,
    rain_temp_points,
    rain_temp_relation,
    temp_distribution,
    temp_outliers,
)
from daygrain.operators.forecast import evaluate, fit_trend, predict, uncertainty
from daygrain.operators.models import dry_spell, moving_avg, rolling_precip, temp_anomaly


def rain(*amounts, **more):
    return [{"day": i, "precipitation_mm": a, **more} for i, a in enumerate(amounts, start=1)]


def temps(*values, **more):
    return [
        {"day": i, "temp_max": v, "temp_min": v, "temp_mean": v, **more}
        for i, v in enumerate(values, start=1)
    ]


@pytest.mark.parametrize("block_days", [None, 1, 2, 3])
@pytest.mark.parametrize(
    ("anchor", "expected", "longest"),
    [("coded", [1, 2, 0, 2, 3], [1, 2, 2, 2, 3]), ("documented", [1, 2, 0, 1, 2], [1, 2, 2, 2, 2])],
)
def test_dry_spell_anchor(observations, anchor, expected, longest, block_days):
    df = dry_spell(observations(*rain(0.0, 0.0, 5.0, 0.0, 0.0)), anchor=anchor, block_days=block_days)
    assert column(df, "dry_spell_days") == expected
    assert column(df, "max_dry_spell_so_far") == longest


def test_dry_spell_labels(observations):
    df = dry_spell(observations(*rain(*[0.0] * 7, 1.0)))
    labels = column(df, "dry_spell_label")
    assert labels[:2] == ["Dry (1-2 days)"] * 2
    assert labels[2:6] == ["Short Dry Spell (3-6 days)"] * 4
    assert labels[6:] == ["Extended Dry Spell (7+ days)", "Rain Day"]


def test_dry_spell_rejects_unknown_anchor(observations):
    with pytest.raises(ValueError, match="anchor"):
        dry_spell(observations(*rain(0.0)), anchor="other")


def test_missing_rain_is_dropped_by_models_but_dry_in_streaks(observations):
    df = observations(*rain(1.0, None, 1.0))
    assert column(dry_spell(df), "dry_spell_days") == [0, 0]
    assert column(rolling_precip(df), "rain_days_last_7") == [1, 2]
    assert sorted(r.streak_length_days for r in rain_streaks(df).collect()) == [1, 1]


def test_frame_grows_to_its_width(observations):
    df = moving_avg(observations(*temps(*map(float, range(8)))))
    assert column(df, "rolling_window_days") == [1, 2, 3, 4, 5, 6, 7, 7]
    assert column(df, "temp_max_7day_avg")[-1] == 4.0


@pytest.mark.parametrize("block_days", [None, 1, 2, 4])
def test_frames_count_rows_across_missing_days(observations, block_days):
    rows = [r for r in temps(*map(float, range(20))) if r["day"] in (1, 2, 3, 10, 20)]
    df = moving_avg(observations(*rows), block_days=block_days)
    assert column(df, "rolling_window_days") == [1, 2, 3, 4, 5]
    assert column(df, "temp_max_7day_avg") == [0.0, 0.5, 1.0, 3.0, 6.2]


def test_moving_avg_needs_all_three_temperatures(observations):
    rows = temps(1.0, 2.0, 3.0)
    rows[1]["temp_min"] = None
    df = moving_avg(observations(*rows))
    assert column(df, "temp_max") == [1.0, 3.0]
    assert column(df, "temp_max_7day_avg") == [1.0, 2.0]


@pytest.mark.parametrize(
    ("total", "label"),
    [
        (25.0, "Normal Period"),
        (25.004, "Wet Period"),
        (25.01, "Wet Period"),
        (0.0, "Dry Period"),
        (0.001, "Normal Period"),
    ],
)
def test_period_label_uses_the_unrounded_sum(observations, total, label):
    df = rolling_precip(observations(*rain(total)))
    assert column(df, "period_label") == [label]


def test_anomaly_limits_are_strict(observations):
    df = temp_anomaly(observations(*temps(8.0, 10.0, 12.0)))
    assert column(df, "temp_max_anomaly") == [-2.0, 0.0, 2.0]
    assert set(column(df, "anomaly_category")) == {"Near Normal"}
    df = temp_anomaly(observations(*temps(7.0, 10.0, 13.0)))
    assert column(df, "anomaly_category") == ["Below Normal", "Near Normal", "Above Normal"]


def test_anomaly_subtracts_the_rounded_average(observations):
    df = temp_anomaly(observations(*temps(0.0, 0.0, 1.0)))
    assert column(df, "avg_temp_max") == [0.33] * 3
    assert column(df, "temp_max_anomaly") == [-0.33, -0.33, 0.67]


def test_anomaly_keeps_rows_without_min_or_mean(observations):
    rows = temps(1.0, 3.0)
    rows[0]["temp_min"] = rows[0]["temp_mean"] = None
    df = temp_anomaly(observations(*rows))
    assert column(df, "temp_min_anomaly") == [None, 0.0]


def test_no_temperature_at_all(observations):
    df = observations(*temps(None, None, None))
    assert moving_avg(df).count() == temp_anomaly(df).count() == 0
    assert column(sigma_flags(df), "anomaly_flag") == ["Normal"] * 3
    assert fit_trend(df).count() == 0


def test_one_row_series(observations):
    df = observations(*temps(5.0))
    (row,) = sigma_flags(df).collect()
    assert (row.city_stddev, row.anomaly_flag) == (None, "Normal")
    (row,) = temp_ranks(df).collect()
    assert (row.temp_percentile, row.temp_quartile) == (0.0, 1)
    assert fit_trend(df).count() == 0


@pytest.mark.parametrize("block_days", [None, 2])
def test_ties_share_a_percentile_and_days_split_the_quartile(observations, block_days):
    df = temp_ranks(observations(*temps(1.0, 1.0, 1.0, 1.0, None)), block_days=block_days)
    assert column(df, "temp_percentile") == [0.0, 0.0, 0.0, 0.0, 1.0]
    assert column(df, "temp_quartile") == [1, 1, 2, 3, 4]


@pytest.mark.parametrize("plan", [{}, {"max_broadcast_rows": 10}, {"block_days": 2}], ids=["window", "broadcast", "blocks"])
def test_sigma_flags_take_the_edge_as_inside(observations, plan):
    # Of 0, 0, 0, x the last is 1.5 deviations above the mean, whatever x is.
    for x in (0.1, 0.3, 0.7, 1.1, 123.4, 9.9e8, -0.3, -17.9):
        assert column(sigma_flags(observations(*temps(0.0, 0.0, 0.0, x)), k=1.5, **plan), "anomaly_flag") == ["Normal"] * 4
    assert column(sigma_flags(observations(*temps(*[0.1] * 7)), **plan), "anomaly_flag") == ["Normal"] * 7


def test_sigma_flags_both_sides(observations):
    df = sigma_flags(observations(*temps(*[0.0] * 10, 100.0)))
    assert column(df, "anomaly_flag")[-1] == "Heat Anomaly"
    df = sigma_flags(observations(*temps(*[0.0] * 10, -100.0)))
    assert column(df, "anomaly_flag")[-1] == "Cold Anomaly"


def test_trend_deviation_keeps_missing_values(observations):
    df = trend_deviation(observations(*temps(1.0, None, 4.0)))
    assert column(df, "rolling_7day_avg") == [1.0, 1.0, 2.5]
    assert column(df, "deviation_from_7day_trend") == [0.0, None, 1.5]


@pytest.mark.parametrize("block_days", [None, 1, 2, 3])
def test_rain_streaks(observations, block_days):
    df = rain_streaks(observations(*rain(1.0, 2.0, 0.0, 3.0, 1.04, 1.04)), block_days=block_days)
    assert [(r.streak_length_days, r.total_rain_mm) for r in df.orderBy("streak_start").collect()] == [
        (2, 3.0),
        (3, 5.1),
    ]


def test_longest_streaks_are_ordered_and_limited(observations):
    rows = [r for c in "ABC" for r in rain(1.0, 0.0, 1.0, 1.0, city=c)]
    top = longest_rain_streaks(observations(*rows), n=4).collect()
    assert [(r.city, r.streak_length_days) for r in top] == [("A", 2), ("B", 2), ("C", 2), ("A", 1)]


def test_comparison_needs_every_series_but_not_every_value(observations):
    rows = [r for c in "ABCD" for r in temps(1.0, None, 3.0, city=c)]
    rows = [r for r in rows if not (r["city"] == "D" and r["day"] == 1)]
    df = compare_series(observations(*rows), ["A", "B", "C", "D"]).orderBy("date")
    assert [(r.date.day, r.s0_temp, r.s0_vs_s1) for r in df.collect()] == [(2, None, None), (3, 3.0, 0.0)]


def test_code_descriptions(spark):
    codes = [0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 80, 81, 82, 95, 96, 99, 4, None]
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    names = [r.d for r in df.select(decode_code("code").alias("d")).collect()]
    assert names[0] == "Clear sky" and names[20] == "Severe thunderstorm"
    assert names[21:] == ["Unknown", "Unknown"]
    assert "Unknown" not in names[:21] and len(set(names[:21])) == 21


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [('"Miami"', datetime.date(2026, 3, 4), 1.005)], "s string, d date, x double"
    )
    row = df.select(
        clean_label("s").alias("s"),
        row_key(clean_label("s"), "d").alias("k"),
        round_half_up("x", 2).alias("r"),
        round_half_up(-F.col("x"), 2).alias("n"),
    ).first()
    assert tuple(row) == ("Miami", "Miami_2026-03-04", 1.01, -1.01)


def test_rounding_equals_the_decimal(spark):
    """On averages of two-place values, where ties are common, and on awkward ones."""
    rng = random.Random(3)
    values = [sum(rng.randint(-9999, 9999) / 100 for _ in range(n)) / n for n in range(1, 31) for _ in range(60)]
    values += [0.0, -0.0, -0.001, 0.005, -0.005, 1.005, 2.675, -2.675, 999999999.995, 1e9, 5e11, -7.5e10, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 2, 3, 4):
        by_decimal = F.round(F.col("x").cast("decimal(18,6)"), digits).cast("double")
        rows = df.select("x", round_half_up("x", digits).alias("ours"), by_decimal.alias("d")).collect()
        assert [(r.x, repr(r.ours)) for r in rows] == [(r.x, repr(r.d)) for r in rows]
    far = [1e13, -1e13, 2.5e12, float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in [*far, float("nan")]], "x double").select(round_half_up("x", 2)).collect()
    assert [r[0] for r in rows[:-1]] == far and rows[-1][0] != rows[-1][0]


def test_last_days_and_recent_loads(observations):
    loads = [datetime.datetime(2026, 3, 5, h) for h in (3, 1, 2)]
    rows = [{**r, "load_ts": t} for r, t in zip(temps(1.0, 2.0, 3.0), loads)]
    df = observations(*rows, {"city": "B", "day": 9})
    assert [r.date.day for r in last_days(df, "A", 2).collect()] == [3, 2]
    # A missing load time counts as the newest.
    assert [r.city for r in recent_loads(df, 2).collect()] == ["B", "A"]


def test_display_order_of_missing_values(observations):
    df = observations(*temps(None, 1.0, 2.0)).select("temp_max")
    values = [r.temp_max for r in sorted_for_display(df, temp_max="asc").collect()]
    assert values == [1.0, 2.0, None]
    values = [r.temp_max for r in sorted_for_display(df, temp_max="desc").collect()]
    assert values == [None, 2.0, 1.0]


def test_relation_without_variation_is_undefined(observations):
    rows = rain(0.0, 0.0, 0.0, temp_max=1.0) + rain(5.0, temp_max=1.0, city="B")
    rows += [{"city": "C", "day": d, "precipitation_mm": float(d), "temp_max": -float(d)} for d in (1, 2)]
    relation = rain_temp_relation(rain_temp_points(rolling_precip(observations(*rows))))
    found = {r.city: (r.n_points, r.correlation, r.slope) for r in relation.collect()}
    assert found == {"A": (3, None, None), "B": (1, None, None), "C": (2, -1.0, -0.5)}


def test_box_plot_and_outliers(observations):
    df = observations(*temps(*map(float, range(1, 9)), 100.0))
    (box,) = temp_distribution(df).collect()
    assert (box.min_value, box.q1, box.median, box.q3, box.max_value) == (1.0, 3.0, 5.0, 7.0, 100.0)
    assert (box.lower_fence, box.upper_fence, box.n_outliers) == (-3.0, 13.0, 1)
    assert [r.temp_max for r in temp_outliers(df).collect()] == [100.0]


def test_monthly_tables(observations):
    rows = [
        {"city": c, "day": d, "temp_max": float(d), "precipitation_mm": 1.0}
        for c in "AB"
        for d in (30, 31, 32, 34)
    ]
    df = observations(*rows, {"city": "C", "day": 1})
    long = {(r.city, r.month.month): r.avg_temp_max for r in monthly_averages(df).collect()}
    assert long == {("A", 3): 30.5, ("A", 4): 33.0, ("B", 3): 30.5, ("B", 4): 33.0, ("C", 3): None}
    found = monthly_pivot(df)
    assert found.columns == ["city", *(f"2026-0{m}_{v}" for m in (3, 4) for v in ("avg_mm", "avg_temp"))]
    by_year = {r.city: (r.year, r.m03_avg_temp, r.m04_avg_temp, r.m05_avg_mm) for r in yearly_pivot(df).collect()}
    assert by_year == {"A": (2026, 30.5, 33.0, None), "B": (2026, 30.5, 33.0, None), "C": (2026, None, None, None)}
    wide = monthly_pivot(df, ["2026-03", "2026-04", "2026-05"]).orderBy("city").collect()
    assert wide[0]["2026-04_avg_temp"] == 33.0 and wide[0]["2026-05_avg_mm"] is None
    assert wide[2]["2026-03_avg_temp"] is None


def test_date_range_and_latest_month(observations):
    df = observations(*temps(*map(float, range(1, 35))))
    assert between_days(df, "2026-03-02", "2026-03-04").count() == 3
    assert column(latest_month(df), "temp_max") == [32.0, 33.0, 34.0]
    cells = anomaly_heatmap(temp_anomaly(df), "2026-03-01", "2026-03-02")
    # Averages come from all days, not from the range shown.
    assert column(cells, "temp_max_anomaly") == [-16.5, -15.5]
    matrix = heatmap_matrix(cells, tile_digits=0).orderBy("date").collect()
    assert [r.cells for r in matrix] == [{"A": -16.5}, {"A": -15.5}]


# --------------------------------------------------------------------------
# Forecast
# --------------------------------------------------------------------------


def test_exact_line_is_continued(observations):
    df = observations(*temps(*[2.0 * d + 1 for d in range(1, 13)]))
    rows = predict(fit_trend(df), periods=3).orderBy("ts").collect()
    assert [r.ts for r in rows] == [datetime.datetime(2026, 3, d) for d in (13, 14, 15)]
    assert [round(r.forecast, 6) for r in rows] == [27.0, 29.0, 31.0]
    assert all(abs(r.upper_bound - r.lower_bound) < 1e-5 for r in rows)


def test_bounds_widen_with_distance_and_level(observations):
    df = observations(*temps(*[float(d % 3) for d in range(12)]))
    model = fit_trend(df)
    rows = uncertainty(predict(model, quote_labels=True)).orderBy("forecast_date").collect()
    assert [r.city for r in rows] == ["A"] * 7
    assert [r.uncertainty_rank for r in rows] == [7, 6, 5, 4, 3, 2, 1]
    narrow = predict(model, level=0.5).first()
    wide = predict(model, level=0.99).first()
    assert wide.upper_bound > narrow.upper_bound


def test_failing_series_is_skipped_or_raised(observations):
    rows = temps(*map(float, range(12))) + temps(1.0, 2.0, city="short")
    df = observations(*rows)
    assert [r.series for r in fit_trend(df).collect()] == ["A"]
    with pytest.raises(Exception, match="cannot fit series short"):
        fit_trend(df, on_error="raise").collect()
    with pytest.raises(ValueError, match="on_error"):
        fit_trend(df, on_error="ignore")


def test_single_series_averages_days_first(observations):
    rows = temps(*map(float, range(12))) + temps(*[float(v + 2) for v in range(12)], city="B")
    df = observations(*rows)
    (model,) = fit_trend(df, series=None).collect()
    assert (model.series, model.n, round(model.mean_y, 6)) == ("all", 12, 6.5)


def test_metrics_of_a_perfect_line(observations):
    df = observations(*temps(*map(float, range(1, 21))))
    values = {r.error_metric: r.metric_value for r in evaluate(df).collect()}
    assert set(values) == {"MAE", "MSE", "MAPE", "SMAPE", "COVERAGE"}
    assert all(abs(values[m]) < 1e-6 for m in ("MAE", "MSE", "MAPE", "SMAPE"))


def test_metrics_guard_against_zero_actuals(observations):
    values = [float(d % 2) for d in range(13)] + [0.0] * 7
    metrics = {r.error_metric: r.metric_value for r in evaluate(observations(*temps(*values))).collect()}
    assert metrics["MAPE"] is None
    assert metrics["MAE"] > 0


def test_metrics_skip_short_series(observations):
    assert evaluate(observations(*temps(*map(float, range(16))))).count() == 0
    assert evaluate(observations(*temps(*map(float, range(17))))).count() == 5
    assert evaluate(observations(*temps(1.0, 2.0))).count() == 0


def test_heatmap_takes_a_range_open_at_one_end(observations):
    cells = models.temp_anomaly(observations(*[{"day": n, "temp_max": float(n)} for n in range(1, 6)]))
    after = dashboard.anomaly_heatmap(cells, start="2026-03-04")
    before = dashboard.anomaly_heatmap(cells, end="2026-03-02")
    assert (after.count(), before.count(), dashboard.anomaly_heatmap(cells).count()) == (2, 2, 5)


def test_checks_of_a_table_with_only_a_series_list(observations):
    only = checks.TableChecks(not_null=(), accepted={"city": checks.SERIES_LIST})
    rows = checks.run_checks({"t": observations({"city": "A"}, {"city": "B"})}, {"t": only}, ["A"]).collect()
    assert [(r.check_name, r.failures) for r in rows] == [("accepted_values", 1)]
