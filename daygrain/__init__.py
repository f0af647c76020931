"""Analytics over daily observations of many series, on Spark DataFrames."""

from daygrain.operators.analytics import (
    compare_series,
    last_days,
    loaded_since,
    longest_rain_streaks,
    rain_streaks,
    recent_loads,
    sigma_flags,
    sorted_for_display,
    temp_ranks,
    trend_deviation,
    weather_descriptions,
)
from daygrain.operators.checks import (
    CheckFailed,
    check_accepted,
    check_not_null,
    check_unique,
    coverage,
    require_passed,
    require_unique,
    row_count,
    run_checks,
)
from daygrain.operators.forecast import (
    evaluate,
    evaluate_moments,
    final_series,
    fit_moments,
    fit_outcomes,
    fit_trend,
    latest_run,
    predict,
    training_set,
    uncertainty,
)
from daygrain.operators.history import open_rows, snapshot_scd2
from daygrain.operators.models import dry_spell, moving_avg, rolling_precip, temp_anomaly
from daygrain.operators.moments import month_moments
from daygrain.operators.seasonal import evaluate_seasonal, forecast_seasonal
from daygrain.operators.series import choose_block_days
from daygrain.operators.upsert import upsert
from daygrain.plans.daily import build_models, ingest, train_and_predict
from daygrain.session import build_session
from daygrain.sources.declared import Declaration, declare
from daygrain.sources.release import Stage, pin, source

__all__ = [
    "CheckFailed",
    "Declaration",
    "Stage",
    "build_models",
    "build_session",
    "check_accepted",
    "check_not_null",
    "check_unique",
    "choose_block_days",
    "compare_series",
    "coverage",
    "declare",
    "dry_spell",
    "evaluate",
    "evaluate_moments",
    "evaluate_seasonal",
    "final_series",
    "fit_moments",
    "fit_outcomes",
    "fit_trend",
    "forecast_seasonal",
    "ingest",
    "last_days",
    "latest_run",
    "loaded_since",
    "longest_rain_streaks",
    "month_moments",
    "moving_avg",
    "open_rows",
    "pin",
    "predict",
    "rain_streaks",
    "recent_loads",
    "require_passed",
    "require_unique",
    "rolling_precip",
    "row_count",
    "run_checks",
    "sigma_flags",
    "snapshot_scd2",
    "sorted_for_display",
    "source",
    "temp_anomaly",
    "temp_ranks",
    "train_and_predict",
    "training_set",
    "trend_deviation",
    "uncertainty",
    "upsert",
    "weather_descriptions",
]
