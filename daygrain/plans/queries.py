"""Registered queries. Each takes (spark, data_dir) and reads whole tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import round_half_up
from daygrain.operators import analytics, checks, dashboard, forecast, history, models, moments, seasonal
from daygrain.operators.joins import BROADCAST_ROWS
from daygrain.operators.upsert import upsert
from daygrain.plans.daily import build_models, ingest, model_tables, train_and_predict
from daygrain.schemas import KEYS, METRICS, MOVING_AVG, OBSERVATIONS, STAGE
from daygrain.session import STAGE_SETTINGS, kept, scratch_path, settings, written
from daygrain.sources import bucketed, declared, files, months, payloads, release, tables
from daygrain.sources.bindings import daily_obs, daily_ship, ship_tasks

# Run times and series names, repeated as literals in the SQL.
LOAD_TS = "2024-02-01 00:00:00"
FIRST_RUN = "2024-01-21 00:00:00"
SECOND_RUN = "2024-02-01 00:00:00"
COMPARED = ("S_0", "S_1", "S_2", "S_3")
#: Short blocks, so that the block-wise plans have many blocks to carry over.
TEST_BLOCK_DAYS = 5

Query = Callable[[SparkSession, str], DataFrame]


def _on_obs(operator, **kwargs) -> Query:
    return lambda spark, d: operator(daily_obs(spark, d), **kwargs)


def _on_ship(operator, **kwargs) -> Query:
    return lambda spark, d: operator(daily_ship(spark, d), **kwargs)


def _on_model(model, operator, **kwargs) -> Query:
    return lambda spark, d: operator(model(daily_obs(spark, d)), **kwargs)


# --------------------------------------------------------------------------
# Ingest
# --------------------------------------------------------------------------


def _landed(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "payloads")
    payloads.write_payloads(payloads.pack_daily(daily_obs(spark, d)), path)
    return path


def flatten_payloads(spark: SparkSession, d: str) -> DataFrame:
    landed = payloads.read_payloads(spark, _landed(spark, d))
    return payloads.flatten_daily(landed)


def series_lookup(spark: SparkSession, d: str) -> DataFrame:
    obs = daily_obs(spark, d)
    series_path = scratch_path(spark, "series")
    payloads.series_of(obs).write.json(series_path)
    series = payloads.read_series(spark, series_path, json_lines=True)
    return payloads.stage_batch(payloads.read_payloads(spark, _landed(spark, d)), series)


def _upsert_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    obs = daily_obs(spark, d)
    target = obs.filter(F.col("date") < F.lit("2024-01-21").cast("date"))
    batch = obs.filter(F.col("date") >= F.lit("2024-01-15").cast("date")).withColumn(
        "temp_max", F.col("temp_max") + 1
    )
    return target, payloads.conform(batch, STAGE)


def upsert_observations(spark: SparkSession, d: str) -> DataFrame:
    target, batch = _upsert_sides(spark, d)
    checks.require_unique(batch, KEYS)
    return upsert(target, batch, KEYS, LOAD_TS)


def upsert_twice(spark: SparkSession, d: str) -> DataFrame:
    """The same batch merged twice into a stored table, month by month."""
    target, batch = _upsert_sides(spark, d)
    path = scratch_path(spark, "upsert_twice")
    tables.upsert_observations(spark, path, payloads.conform(target, STAGE), FIRST_RUN)
    tables.upsert_observations(spark, path, batch, LOAD_TS)
    tables.upsert_observations(spark, path, batch, "2024-02-02 00:00:00")
    return tables.read_observations(spark, path)


def _on_bucketed(operator) -> Query:
    """An operator on the fact table after two upserts into a table bucketed by series."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        target, batch = _upsert_sides(spark, d)
        name = f"observations_{uuid.uuid4().hex}"
        bucketed.register(spark, name, scratch_path(spark, "bucketed"), buckets=8)
        try:
            bucketed.upsert_bucketed(spark, name, payloads.conform(target, STAGE), FIRST_RUN)
            bucketed.upsert_bucketed(spark, name, batch, LOAD_TS)
            return written(operator(bucketed.read(spark, name)), "from-bucketed")
        finally:
            bucketed.drop(spark, name)

    return run


def upsert_touch(spark: SparkSession, d: str) -> DataFrame:
    target, batch = _upsert_sides(spark, d)
    checks.require_unique(batch, KEYS)
    return upsert(target, batch, KEYS, LOAD_TS, touch_on_update=True)


def publish_reload(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "publish_reload")
    table = models.moving_avg(daily_obs(spark, d))
    tables.publish(table, path, sort_by=KEYS)
    return tables.load(spark, path, MOVING_AVG)


def _metrics_log(spark: SparkSession, d: str) -> DataFrame:
    """Two runs appended to one log: an early state of the table and the whole."""
    path = scratch_path(spark, "metrics")
    training = forecast.training_set(daily_obs(spark, d))
    early = training.filter(F.col("date") <= F.lit("2024-01-24").cast("date"))
    for data, run_ts in ((early, FIRST_RUN), (training, SECOND_RUN)):
        tables.append_run(forecast.evaluate(data), path, run_ts)
    log = tables.read_log(spark, path, METRICS)
    return log.withColumn("metric_value", round_half_up("metric_value", 4))


def latest_metrics(spark: SparkSession, d: str) -> DataFrame:
    return forecast.latest_run(_metrics_log(spark, d))


def described(spark: SparkSession, d: str) -> DataFrame:
    return tables.describe_table(daily_obs(spark, d))


# --------------------------------------------------------------------------
# Validation
# --------------------------------------------------------------------------


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    obs = daily_obs(spark, d)
    again = obs.filter(F.col("date") == F.lit("2024-01-10").cast("date"))
    return checks.check_unique(obs.unionByName(again), KEYS)


def check_results(spark: SparkSession, d: str) -> DataFrame:
    """The standard checks on model tables with faults put in, so some fail."""
    obs = daily_obs(spark, d)
    built = model_tables(obs)
    faulty_day = F.col("date") == F.lit("2024-01-03").cast("date")
    built["temp_anomaly"] = built["temp_anomaly"].withColumn(
        "anomaly_category",
        F.when(faulty_day, F.lit("Odd")).otherwise(F.col("anomaly_category")),
    )
    built["dry_spell"] = built["dry_spell"].withColumn(
        "dry_spell_label", F.when(~faulty_day, F.col("dry_spell_label"))
    )
    known = obs.filter(F.col("latitude") != 25).select("city")
    return checks.run_checks({**built, "city_weather": obs}, series_list=known)


def stop_on_failure(spark: SparkSession, d: str) -> DataFrame:
    """Whether the faulty tables stop the pipeline, and whether sound ones do."""
    obs = daily_obs(spark, d)
    outcomes = []
    for name, results in (
        ("faulty", check_results(spark, d)),
        ("sound", checks.run_checks({"city_weather": obs})),
    ):
        try:
            passed = checks.require_passed(results).count()
            outcomes.append((name, False, passed))
        except checks.CheckFailed as failure:
            outcomes.append((name, True, int(str(failure).split()[0])))
    return spark.createDataFrame(outcomes, "tables string, stopped boolean, n_checks bigint")


# --------------------------------------------------------------------------
# Stages
# --------------------------------------------------------------------------


def unlisted_series(spark: SparkSession, d: str) -> DataFrame:
    """A batch of all series against a list that lacks those of one latitude."""
    obs = daily_obs(spark, d)
    listed = payloads.series_of(obs).filter(F.col("lat") != 25)
    return payloads.stage_batch(payloads.read_payloads(spark, _landed(spark, d)), listed)


def load_time_default(spark: SparkSession, d: str) -> DataFrame:
    """New rows get the load time of their run, earlier ones keep theirs."""
    target, batch = _upsert_sides(spark, d)
    start = F.lit(datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    merged = upsert(target, batch, KEYS)
    return merged.select("city", "date", (F.col("load_ts") >= start).alias("loaded_now"))


def _after_stages(result, build: bool = False) -> Query:
    """A result read back from the stored tables after the stages ran on landed payloads."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        root = scratch_path(spark, "stages")
        payloads.write_payloads(payloads.pack_daily(daily_obs(spark, d)), f"{root}/landing")
        known = payloads.series_of(daily_obs(spark, d))
        known.select(F.col("city"), "lat", "lon").write.json(f"{root}/series")
        ingest(spark, f"{root}/landing", f"{root}/series", root, LOAD_TS, json_lines=True)
        train_and_predict(spark, root, SECOND_RUN)
        if build:
            build_models(spark, root, f"{root}/series", SECOND_RUN, json_lines=True)
        return result(spark, root)

    return run


#: The second batch of shipments begins here, and corrects days that the first one had.
GROWN_FROM, GROWN_TO = "1997-06-15", "1997-07-01"


def _month_by_month(name: str) -> Query:
    """A rolling model after two ingests and two builds, the second of which starts at the touched months."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        root = scratch_path(spark, "month_by_month")
        # Derived once: both batches and the list of series are read from it. What has been read goes.
        with settings(spark, STAGE_SETTINGS), kept(daily_ship(spark, d), "shipped") as obs:
            payloads.series_of(obs).write.json(f"{root}/series")
            first = obs.filter(F.col("date") < F.lit(GROWN_TO).cast("date"))
            second = obs.filter(F.col("date") >= F.lit(GROWN_FROM).cast("date")).withColumn(
                "temp_max", F.col("temp_max") + 1
            )
            for n, batch in enumerate((first, second)):
                payloads.write_payloads(payloads.pack_daily(batch), f"{root}/landing-{n}")
        for n, run_ts in enumerate((FIRST_RUN, SECOND_RUN)):
            ingest(spark, f"{root}/landing-{n}", f"{root}/series", root, run_ts, require_all=False, json_lines=True)
            files.delete(spark, f"{root}/landing-{n}")
            build_models(spark, root, f"{root}/series", run_ts, json_lines=True, incremental=True)
        return release.source(spark, name, root)

    return run


def _trained_twice(result) -> Query:
    """What is stored after two overlapping ingests and the same training run twice."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        root = scratch_path(spark, "trained")
        obs = daily_obs(spark, d)
        payloads.series_of(obs).write.json(f"{root}/series")
        day = F.col("date")
        parts = (day < F.lit("2024-01-21").cast("date"), day >= F.lit("2024-01-15").cast("date"))
        for n, part in enumerate(parts):
            payloads.write_payloads(payloads.pack_daily(obs.filter(part)), f"{root}/landing-{n}")
            ingest(spark, f"{root}/landing-{n}", f"{root}/series", root, LOAD_TS, require_all=False, json_lines=True)
        for _ in range(2):
            train_and_predict(spark, root, SECOND_RUN)
        return result(spark, root)

    return run


def _stored_forecast(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(release.source(spark, "adhoc.city_weather_forecast", root), *_FORECAST_COLUMNS)


def _stored_metrics(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(release.source(spark, "analytics.city_weather_model_metrics", root), "metric_value")


def _stored_outcomes(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(release.source(spark, "analytics.city_weather_fit_outcomes", root), "sxx")


def fit_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of every series, one of which has lost its values and one most of its days."""
    obs = daily_obs(spark, d).withColumn("temp_max", F.when(F.col("city") != "S_3", F.col("temp_max")))
    short = (F.col("city") != "S_5") | (F.col("date") <= F.lit("2024-01-05").cast("date"))
    return _rounded(forecast.fit_outcomes(moments.month_moments(obs.filter(short))), "sxx")


def month_moments(spark: SparkSession, d: str) -> DataFrame:
    """Days counted from the first one of the month, spreads as deviations."""
    rows = moments.month_moments(daily_ship(spark, d), tasks=ship_tasks(spark, d)).select(
        "series",
        "month",
        "n_rows",
        "n",
        (F.col("mean_x") - F.unix_date("month")).alias("mean_x"),
        "mean_y",
        "sxx",
        F.sqrt(F.try_divide("syy", "n")).alias("deviation"),
        F.try_divide("sxy", "n").alias("covariance"),
        "last_day",
    )
    return _rounded(rows, "mean_x", "mean_y", "sxx", "deviation", "covariance")


def refused_build(spark: SparkSession, d: str) -> DataFrame:
    """The model that readers see after a build whose checks failed: the one of the build before."""
    root = scratch_path(spark, "refused")
    obs = written(daily_obs(spark, d), "observed")
    known = payloads.series_of(obs)
    known.write.json(f"{root}/series")
    known.filter(F.col("lat") != 25).write.json(f"{root}/fewer")
    early = obs.filter(F.col("date") < F.lit("2024-01-21").cast("date"))
    for name, batch in (("early", early), ("whole", obs)):
        payloads.write_payloads(payloads.pack_daily(batch), f"{root}/{name}")
        ingest(spark, f"{root}/{name}", f"{root}/series", root, LOAD_TS, require_all=False, json_lines=True)
        if name == "early":
            build_models(spark, root, f"{root}/series", FIRST_RUN, json_lines=True)
    try:
        build_models(spark, root, f"{root}/fewer", SECOND_RUN, json_lines=True)
        raise AssertionError("a build with unknown series passed")
    except checks.CheckFailed:
        return release.source(spark, "dbt.rolling_precip", root)


# --------------------------------------------------------------------------
# Declared tables
# --------------------------------------------------------------------------


def _ledger(spark: SparkSession, label: str) -> str:
    """An empty table with key, required column and a default."""
    path = scratch_path(spark, label)
    ledger = declared.Declaration(
        OBSERVATIONS, key=KEYS, not_null=("latitude",), defaults={"load_ts": f"timestamp_ntz '{LOAD_TS}'"}
    )
    declared.declare(spark, path, ledger)
    return path


def declared_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Rows written without a load time, or with one before a given day only, as the table holds them."""
    path = _ledger(spark, "defaults")
    obs = daily_obs(spark, d)
    early = F.col("date") < F.lit("2024-01-16").cast("date")
    months.write(obs.withColumn("load_ts", F.when(early, F.col("load_ts"))), path)
    return months.read(spark, path, OBSERVATIONS).drop("month")


def declared_refusals(spark: SparkSession, d: str) -> DataFrame:
    """Which of five commits a declared table takes, and how many rows it has after each."""
    path = _ledger(spark, "refusals")
    obs = daily_obs(spark, d)
    tenth = obs.filter(F.col("date") == F.lit("2024-01-10").cast("date"))
    attempts = {
        "sound": obs.drop("load_ts"),
        "repeated key": obs.unionByName(tenth),
        "missing key": obs.withColumn("city", F.when(F.col("city") != "S_7", F.col("city"))),
        "missing value": obs.withColumn("latitude", F.when(F.col("latitude") != 25, F.col("latitude"))),
        "unknown column": obs.withColumn("altitude", F.lit(1.0)),
    }
    outcomes = []
    for name, rows in attempts.items():
        try:
            months.write(rows, path)
            taken = True
        except checks.CheckFailed:
            taken = False
        outcomes.append((name, taken, months.read(spark, path, OBSERVATIONS).count()))
    return spark.createDataFrame(outcomes, "attempt string, taken boolean, n_rows bigint")


def stage_final(spark: SparkSession, d: str) -> DataFrame:
    """The stored final table, whose forecast part was read back rather than predicted again."""
    final = _after_stages(lambda s, root: release.source(s, "analytics.city_weather_final", root))
    return _rounded(final(spark, d), *_FORECAST_COLUMNS)


# --------------------------------------------------------------------------
# Forecast
# --------------------------------------------------------------------------

_FORECAST_COLUMNS = ("forecast", "lower_bound", "upper_bound")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *[round_half_up(c, 4).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _forecast(spark: SparkSession, d: str, quoted: bool = False) -> DataFrame:
    model = forecast.fit_trend(forecast.training_set(daily_obs(spark, d)))
    return forecast.predict(model, quote_labels=quoted)


def forecast_7d(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_forecast(spark, d), *_FORECAST_COLUMNS)


def forecast_single_series(spark: SparkSession, d: str) -> DataFrame:
    model = forecast.fit_trend(daily_obs(spark, d), series=None)
    return _rounded(forecast.predict(model), *_FORECAST_COLUMNS)


def forecast_ship(spark: SparkSession, d: str) -> DataFrame:
    model = forecast.fit_trend(forecast.training_set(daily_ship(spark, d)))
    return _rounded(forecast.predict(model), *_FORECAST_COLUMNS)


def forecast_seasonal(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(seasonal.forecast_seasonal(daily_ship(spark, d)), *_FORECAST_COLUMNS)


def seasonal_metrics(spark: SparkSession, d: str) -> DataFrame:
    """With the root of the mean square, which has fewer digits than the square."""
    metrics = seasonal.evaluate_seasonal(daily_ship(spark, d))
    square = F.col("error_metric") == "MSE"
    rooted = metrics.select(
        "series",
        F.when(square, "RMSE").otherwise(F.col("error_metric")).alias("error_metric"),
        F.when(square, F.sqrt("metric_value")).otherwise(F.col("metric_value")).alias("metric_value"),
    )
    return _rounded(rooted, "metric_value")


def forecast_metrics(spark: SparkSession, d: str) -> DataFrame:
    metrics = forecast.evaluate(forecast.training_set(daily_obs(spark, d)))
    return _rounded(metrics, "metric_value")


def final_series(spark: SparkSession, d: str) -> DataFrame:
    joined = forecast.final_series(daily_obs(spark, d), _forecast(spark, d, quoted=True))
    return _rounded(joined, *_FORECAST_COLUMNS)


def forecast_uncertainty(spark: SparkSession, d: str) -> DataFrame:
    return forecast.uncertainty(_forecast(spark, d, quoted=True))


# --------------------------------------------------------------------------
# History
# --------------------------------------------------------------------------


def _states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Before: the first 20 days. After: keys removed, values changed, days added."""
    obs = daily_obs(spark, d).select(*STAGE.names)
    before = obs.filter(F.col("date") <= F.lit("2024-01-20").cast("date"))
    removed = (F.col("latitude") == 30) & (F.col("date") <= F.lit("2024-01-05").cast("date"))
    after = (
        obs.filter(~removed)
        .withColumn(
            "temp_max",
            F.when(F.col("latitude") == 31, F.col("temp_max") + 1).otherwise(F.col("temp_max")),
        )
        .withColumn("precipitation_mm", F.coalesce("precipitation_mm", F.lit(0.0)))
    )
    return before, after


def _snapshots(strategy: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        before, after = _states(spark, d)
        first = history.snapshot_scd2(None, before, FIRST_RUN, strategy)
        return history.snapshot_scd2(first, after, SECOND_RUN, strategy)

    return run


def snapshot_missing_keys(spark: SparkSession, d: str) -> DataFrame:
    """A stored history of rows without a series or a day: two runs without changes, then one with."""
    obs = daily_obs(spark, d).select(*STAGE.names)
    tenth = F.col("date") == F.lit("2024-01-10").cast("date")
    keyless = obs.withColumns(
        {
            "city": F.when(F.col("city") != "S_7", F.col("city")),
            "date": F.when(~((F.col("city") == "S_8") & tenth), F.col("date")),
        }
    )
    changed = keyless.withColumn(
        "temp_min", F.when(F.col("city").isNull() | F.col("date").isNull(), F.lit(-1.0)).otherwise(F.col("temp_min"))
    )
    path = scratch_path(spark, "keyless")
    for state, run_ts in ((keyless, FIRST_RUN), (keyless, "2024-01-25 00:00:00"), (changed, SECOND_RUN)):
        tables.write_snapshot(spark, path, state, run_ts, "check")
    return tables.read_history(spark, path)


def snapshot_stored(spark: SparkSession, d: str) -> DataFrame:
    """Both runs on a stored history, where the second rewrites what changed."""
    path = scratch_path(spark, "history")
    for state, run_ts in zip(_states(spark, d), (FIRST_RUN, SECOND_RUN)):
        tables.write_snapshot(spark, path, state, run_ts, "check")
    return tables.read_history(spark, path)


# --------------------------------------------------------------------------
# Dashboard
# --------------------------------------------------------------------------


def heatmap_matrix(spark: SparkSession, d: str) -> DataFrame:
    cells = dashboard.anomaly_heatmap(models.temp_anomaly(daily_obs(spark, d)))
    matrix = dashboard.heatmap_matrix(cells)
    values = F.transform(F.map_values("cells"), lambda v: F.format_string("%.2f", v))
    return matrix.select(
        "date",
        "tile",
        F.size("cells").cast("bigint").alias("n_series"),
        F.array_join(F.map_keys("cells"), ",").alias("series"),
        F.array_join(values, ",").alias("anomalies"),
    )


def rain_temp_corr(spark: SparkSession, d: str) -> DataFrame:
    table = models.rolling_precip(daily_obs(spark, d))
    return dashboard.rain_temp_relation(dashboard.rain_temp_points(table))


QUERIES: dict[str, Query] = {
    # models
    "moving_avg": _on_obs(models.moving_avg),
    "temp_anomaly": _on_obs(models.temp_anomaly),
    "rolling_precip": _on_obs(models.rolling_precip),
    "dry_spell": _on_obs(models.dry_spell),
    "dry_spell_documented": _on_obs(models.dry_spell, anchor="documented"),
    "moving_avg_ship": _on_ship(models.moving_avg),
    "temp_anomaly_ship": _on_ship(models.temp_anomaly),
    "rolling_precip_ship": _on_ship(models.rolling_precip),
    "dry_spell_ship": _on_ship(models.dry_spell),
    # the same in calendar blocks
    "moving_avg_blocks": _on_obs(models.moving_avg, block_days=TEST_BLOCK_DAYS),
    "temp_anomaly_blocks": _on_obs(models.temp_anomaly, block_days=TEST_BLOCK_DAYS),
    "rolling_precip_blocks": _on_obs(models.rolling_precip, block_days=TEST_BLOCK_DAYS),
    "dry_spell_blocks": _on_obs(models.dry_spell, block_days=TEST_BLOCK_DAYS),
    "trend_deviation_blocks": _on_obs(analytics.trend_deviation, block_days=TEST_BLOCK_DAYS),
    "sigma_flags_blocks": _on_obs(analytics.sigma_flags, block_days=TEST_BLOCK_DAYS),
    "temp_ranks_blocks": _on_obs(analytics.temp_ranks, block_days=TEST_BLOCK_DAYS),
    "temp_distribution_blocks": _on_obs(
        dashboard.temp_distribution, block_days=TEST_BLOCK_DAYS
    ),
    "rain_streaks_blocks": _on_obs(analytics.rain_streaks, block_days=TEST_BLOCK_DAYS),
    # ... and with the averages of a counted number of series broadcast
    "temp_anomaly_few_series": _on_obs(models.temp_anomaly, max_broadcast_rows=BROADCAST_ROWS),
    "sigma_flags_few_series": _on_obs(analytics.sigma_flags, max_broadcast_rows=BROADCAST_ROWS),
    # analytics
    "trend_deviation": _on_obs(analytics.trend_deviation),
    "sigma_flags": _on_obs(analytics.sigma_flags),
    "temp_ranks": _on_obs(analytics.temp_ranks),
    "rain_streaks": _on_obs(analytics.rain_streaks),
    "rain_streaks_top10": _on_obs(analytics.longest_rain_streaks),
    "compare_series": _on_obs(analytics.compare_series, names=COMPARED),
    "weather_descriptions": _on_obs(analytics.weather_descriptions),
    "trend_deviation_ship": _on_ship(analytics.trend_deviation),
    "temp_ranks_ship": _on_ship(analytics.temp_ranks),
    "rain_streaks_ship": _on_ship(analytics.rain_streaks),
    # ingest, tables
    "flatten_payloads": flatten_payloads,
    "series_lookup": series_lookup,
    "upsert_observations": upsert_observations,
    "upsert_touch": upsert_touch,
    "upsert_bucketed": _on_bucketed(lambda table: table),
    "moving_avg_bucketed": _on_bucketed(models.moving_avg),
    "unlisted_series": unlisted_series,
    "load_time_default": load_time_default,
    "stage_source_scan": _after_stages(lambda spark, root: release.source(spark, "raw.city_weather", root)),
    "stage_final_series": stage_final,
    "stage_train_view": _after_stages(lambda spark, root: spark.table("city_weather_train_view")),
    "stage_dashboard_dataset": _after_stages(
        lambda spark, root: release.source(spark, "dbt.rolling_precip", root), build=True
    ),
    "stage_forecast": _trained_twice(_stored_forecast),
    "stage_metrics_repeated": _trained_twice(_stored_metrics),
    "stage_fit_outcomes": _trained_twice(_stored_outcomes),
    "stage_refused_build": refused_build,
    "moving_avg_month_by_month": _month_by_month("dbt.moving_avg"),
    "rolling_precip_month_by_month": _month_by_month("dbt.rolling_precip"),
    "dry_spell_month_by_month": _month_by_month("dbt.dry_spell"),
    "declared_defaults": declared_defaults,
    "declared_refusals": declared_refusals,
    "upsert_twice": upsert_twice,
    "publish_reload": publish_reload,
    "append_metrics": _metrics_log,
    "describe_observations": described,
    # validation
    "row_count": _on_obs(checks.row_count),
    "series_coverage": _on_obs(checks.coverage),
    "duplicate_keys": duplicate_keys,
    "recent_loads": _on_obs(analytics.recent_loads),
    "loaded_since": _on_obs(analytics.loaded_since, moment="2024-01-25"),
    "last_days_of_series": _on_obs(analytics.last_days, name="S_7"),
    "check_results": check_results,
    "stop_on_failure": stop_on_failure,
    # forecast
    "training_set": _on_obs(forecast.training_set),
    "forecast_7d": forecast_7d,
    "forecast_single_series": forecast_single_series,
    "forecast_ship": forecast_ship,
    "forecast_metrics": forecast_metrics,
    "forecast_seasonal": forecast_seasonal,
    "forecast_seasonal_obs": lambda spark, d: _rounded(
        seasonal.forecast_seasonal(daily_obs(spark, d)), *_FORECAST_COLUMNS
    ),
    "seasonal_metrics": seasonal_metrics,
    "latest_metrics": latest_metrics,
    "fit_outcomes": fit_outcomes,
    "month_moments": month_moments,
    "final_series": final_series,
    "forecast_uncertainty": forecast_uncertainty,
    # history
    "snapshot_timestamp": _snapshots("timestamp"),
    "snapshot_check": _snapshots("check"),
    "snapshot_stored": snapshot_stored,
    "snapshot_missing_keys": snapshot_missing_keys,
    # dashboard
    "climate_profile": _on_model(models.moving_avg, dashboard.climate_profile),
    "rolling_trend": _on_model(models.moving_avg, dashboard.rolling_trend),
    "temp_wind_profile": _on_model(models.moving_avg, dashboard.temp_wind_profile),
    "max_dry_spell": _on_model(models.dry_spell, dashboard.max_dry_spell),
    "latest_month_avg": _on_model(models.moving_avg, dashboard.latest_month_avg),
    "anomaly_heatmap": lambda spark, d: dashboard.anomaly_heatmap(
        models.temp_anomaly(daily_obs(spark, d)), "2024-01-11", "2024-01-25"
    ),
    "anomaly_heatmap_matrix": heatmap_matrix,
    "avg_rainy_days": _on_model(models.rolling_precip, dashboard.avg_rainy_days),
    "rain_temp_points": _on_model(models.rolling_precip, dashboard.rain_temp_points),
    "rain_temp_corr": rain_temp_corr,
    "temp_distribution": _on_obs(dashboard.temp_distribution),
    "temp_outliers": _on_obs(dashboard.temp_outliers),
    "temp_outliers_blocks": _on_obs(dashboard.temp_outliers, block_days=TEST_BLOCK_DAYS),
    "temp_distribution_ship": _on_ship(dashboard.temp_distribution),
    "monthly_averages": _on_model(models.rolling_precip, dashboard.monthly_averages),
    "monthly_averages_ship": _on_ship(dashboard.monthly_averages),
    "monthly_pivot": _on_ship(dashboard.yearly_pivot),
}
