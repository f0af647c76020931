"""The three daily stages as ordinary function calls: ingest, forecast, build.

Each stage reads named tables under ``root`` and commits all that it writes at once
(:mod:`daygrain.sources.release`): named readers see the tables of before or after a stage,
and a stage that is cut off, or whose checks fail, leaves them as they were. Order between
stages is the caller's.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.operators.carry import carry_over, frame_rows
from daygrain.operators.checks import (
    RESULTS,
    STANDARD_CHECKS,
    Checking,
    known_series,
    require_passed,
)
from daygrain.operators.forecast import (
    evaluate_moments,
    final_series,
    fit_moments,
    fit_outcomes,
    predict,
    training_set,
)
from daygrain.operators.joins import BROADCAST_ROWS
from daygrain.operators.models import dry_spell, moving_avg, rolling_precip, temp_anomaly
from daygrain.operators.moments import month_moments
from daygrain.operators.series import choose_block_days
from daygrain.session import STAGE_SETTINGS, settings
from daygrain.sources import bucketed
from daygrain.sources import months as monthly
from daygrain.sources.payloads import read_payloads, read_series, require_payloads, stage_batch
from daygrain.sources.release import Stage, source
from daygrain.sources.tables import create_view, merge_batch, snapshot_batch, write_snapshot

RAW = "raw.city_weather"
FORECAST_TABLE = "adhoc.city_weather_forecast"
MOMENTS_TABLE = "adhoc.city_weather_moments"
CARRY_TABLE = "adhoc.city_weather_carry"
FINAL_TABLE = "analytics.city_weather_final"
METRICS_TABLE = "analytics.city_weather_model_metrics"
OUTCOMES_TABLE = "analytics.city_weather_fit_outcomes"
HISTORY_TABLE = "dbt.city_weather_snapshot"
TRAIN_VIEW = "city_weather_train_view"
BY_DAY = ("city", "date")


def _settled(stage: Callable) -> Callable:
    """A stage under its settings; those of the session are back once it ends."""

    @wraps(stage)
    def run(spark: SparkSession, *args, **kwargs):
        with settings(spark, STAGE_SETTINGS):
            return stage(spark, *args, **kwargs)

    return run


@_settled
def ingest(
    spark: SparkSession,
    landing: str,
    series_path: str,
    root: str,
    load_ts: str,
    bucketed_table: str | None = None,
    require_all: bool = True,
    json_lines: bool = False,
) -> None:
    """Payload files of all series into the fact table, in one distributed job.

    A listed series without a payload stops the load before anything is written, unless
    ``require_all`` is off; payloads of unlisted series are left out. ``json_lines``: see
    :func:`daygrain.sources.payloads.read_series`.
    The moments of the touched months are renewed in the same commit.
    ``bucketed_table`` names a registered fact table (:mod:`daygrain.sources.bucketed`)
    to use in place of the one under ``root``; so in all three stages.
    """
    payloads, series = read_payloads(spark, landing), read_series(spark, series_path, json_lines)
    if require_all:
        require_payloads(payloads, series)
    batch = stage_batch(payloads, series)
    if bucketed_table:
        bucketed.upsert_bucketed(spark, bucketed_table, batch, load_ts)
        return
    stage = Stage(spark, root)
    merged = merge_batch(spark, stage.path(RAW), batch, load_ts, entries=stage.base.entries(RAW))
    stage.replace(RAW, merged)
    renew_moments(stage)
    stage.commit()


def renew_moments(stage: Stage) -> list[datetime.date]:
    """Bring the moments of a stage up to its fact table; returns the months that were read for it.

    Manifests say which months have changed, so nothing is read where nothing has.
    """
    outdated = stage.outdated(MOMENTS_TABLE, stage.months_held(RAW))
    months = monthly.months_in(outdated)
    if months:
        moments = month_moments(stage.table(RAW, months=months))
        stage.replace_months(MOMENTS_TABLE, moments, ("series",), drop=list(outdated), sources=outdated)
    return months


def _observations(spark: SparkSession, stage: Stage, bucketed_table: str | None) -> DataFrame:
    if bucketed_table:
        return bucketed.read(spark, bucketed_table)
    return stage.table(RAW)


@_settled
def train_and_predict(
    spark: SparkSession,
    root: str,
    run_ts: str,
    periods: int = 7,
    level: float = 0.95,
    bucketed_table: str | None = None,
) -> None:
    """Fit every series; publish the forecast and the final table, log metrics and what became of each series.

    Fits, metrics and outcomes come from the stored moments, so only the final table reads
    the fact table. All four tables change in one commit. A run that is repeated replaces
    what it logged before.
    """
    stage = Stage(spark, root)
    raw = _observations(spark, stage, bucketed_table)
    create_view(training_set(raw), TRAIN_VIEW)
    if bucketed_table:
        moments = month_moments(raw)
    else:
        renew_moments(stage)
        # The month a row is stored in is the month its moments are of.
        moments = stage.table(MOMENTS_TABLE, months=monthly.months_in(stage.seen().entries(MOMENTS_TABLE)))
    stage.rebuild(FORECAST_TABLE, predict(fit_moments(moments), periods, level))
    # Read back, so that the final table shows the forecast that was published.
    final = final_series(raw, stage.table(FORECAST_TABLE))
    stage.rebuild(FINAL_TABLE, final, sort_by=BY_DAY)
    stage.log(METRICS_TABLE, evaluate_moments(moments, level=level), run_ts)
    stage.log(OUTCOMES_TABLE, fit_outcomes(moments), run_ts)
    stage.commit()


def model_tables(
    raw: DataFrame, block_days: int | None = None, max_broadcast_rows: int | None = None
) -> dict[str, DataFrame]:
    return {
        "moving_avg": moving_avg(raw, block_days=block_days),
        "temp_anomaly": temp_anomaly(
            raw, block_days=block_days, max_broadcast_rows=max_broadcast_rows
        ),
        "rolling_precip": rolling_precip(raw, block_days=block_days),
        "dry_spell": dry_spell(raw, block_days=block_days),
    }


#: The models whose rows depend on earlier rows only, so that later months follow from a carry.
ROLLING = ("moving_avg", "rolling_precip", "dry_spell")


@_settled
def build_models(
    spark: SparkSession,
    root: str,
    series_path: str,
    run_ts: str,
    strategy: str = "timestamp",
    bucketed_table: str | None = None,
    by_month: bool = False,
    json_lines: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Rebuild the model tables, check them, record history, and make all of it visible at once.

    The tables are checked while they are written, where nothing reads them yet. A failing
    check raises, and readers keep the models and the history they had. ``by_month`` stores
    the model tables by month. Returns the check results.

    ``incremental`` keeps the rolling models by month and builds only the months from the first
    one that has changed on; checks then cover what is built. The anomalies, which compare
    every day with the average of all, are rebuilt if anything has changed.
    """
    if incremental and bucketed_table:
        raise ValueError("months of a bucketed table are not tracked; build it as a whole")
    stage = Stage(spark, root)
    raw = _observations(spark, stage, bucketed_table)
    known = known_series(read_series(spark, series_path, json_lines).select("city"))
    checking = {name: Checking(name, STANDARD_CHECKS[name], known) for name in STANDARD_CHECKS}
    built = []
    if incremental:
        built = _build_changed(stage, checking)
    else:
        # The stored table is cheap to ask: both questions read a single column.
        for name, table in model_tables(raw, choose_block_days(raw), BROADCAST_ROWS).items():
            watch = checking[name].watch
            stage.rebuild(f"dbt.{name}", table, sort_by=BY_DAY, by_month=by_month, watch=watch)
            built.append(name)
    found = [row for name in built for row in checking[name].found()]
    found += _fact_checks(stage, raw if bucketed_table else None, checking["city_weather"])
    results = require_passed(spark.createDataFrame(found, RESULTS))
    if bucketed_table:
        write_history(stage, raw, run_ts, strategy)
    else:
        write_changed_history(stage, run_ts, strategy)
    stage.commit()
    return results


def _fact_checks(stage: Stage, raw: DataFrame | None, checking: Checking) -> list[tuple]:
    """The checks of the fact table, which ask for its keys only: answered by the number of rows in the moments."""
    if raw is not None:
        return [tuple(row) for row in checking.results(raw).collect()]
    renew_moments(stage)
    held = stage.seen().entries(MOMENTS_TABLE)
    keys = stage.table(MOMENTS_TABLE, months=monthly.months_in(held)).select(
        F.col("series").alias("city"), F.col("month").alias("date"), "n_rows"
    )
    rows = F.coalesce("n_rows", F.lit(0))
    counts = keys.agg(*[F.coalesce(F.sum(F.when(test, rows)), F.lit(0)) for _, _, test in checking.tests]).first()
    return [(checking.name, column, kind, n) for (column, kind, _), n in zip(checking.tests, counts)]


def _build_changed(stage: Stage, checking: dict[str, Checking]) -> list[str]:
    """The models from the first changed month on, and the carry after each of their months.

    The rolling models are built run by run of months (:func:`daygrain.sources.months.runs`), each
    from its rows and the carry of the run before, so what is shuffled at once does not grow with
    the table. The anomalies, which move all rows at once, come while least else is stored.
    """
    held = stage.months_held(RAW)
    outdated = stage.outdated(CARRY_TABLE, held)
    for name in ROLLING:
        outdated |= stage.outdated(f"dbt.{name}", held)
    built = list(ROLLING) if outdated else []
    if stage.outdated("dbt.temp_anomaly", held):
        table = temp_anomaly(stage.table(RAW), max_broadcast_rows=BROADCAST_ROWS)
        stage.rebuild("dbt.temp_anomaly", table, sort_by=BY_DAY, watch=checking["temp_anomaly"].watch)
        stage.note("dbt.temp_anomaly", held)
        built.append("temp_anomaly")
    if outdated:
        first = monthly.months_in(outdated)[0]
        earlier = [m for m in monthly.months_in(held) if m < first]
        months = [m for m in monthly.months_in(held) if m >= first]
        # Of the earlier months, one month of the carry is read and no row.
        before = stage.table(CARRY_TABLE, months=earlier[-1:]) if earlier else None
        for run in monthly.runs(stage.spark, stage.path(RAW), months, held):
            _build_run(stage, checking, run, {part: held[part] for part in map(monthly.folder_name, run)}, before)
            before = stage.table(CARRY_TABLE, months=run[-1:])
    return built


def _build_run(
    stage: Stage, checking: dict[str, Checking], months: list, sources: dict[str, str], before: DataFrame | None
) -> None:
    """The rolling models and the carry of some months, ``before`` being the carry of the month before them."""
    rows = stage.table(RAW, months=months)
    state = None if before is None else before.drop("month")
    temps, rain = (None if state is None else frame_rows(state, tail) for tail in ("temps", "rain"))
    models = {
        "moving_avg": moving_avg(rows, before=temps),
        "rolling_precip": rolling_precip(rows, before=rain),
        "dry_spell": dry_spell(rows, before=state),
    }
    for name, table in models.items():
        batch = monthly.write_batch(
            checking[name].marked(table), stage.path(f"dbt.{name}"), BY_DAY, checking[name].watch
        )
        stage.replace(f"dbt.{name}", batch, drop=list(sources), sources=sources)
    spells = stage.table("dbt.dry_spell", months=months)
    after = carry_over(rows, spells, months, before)
    stage.replace_months(CARRY_TABLE, after, ("city",), drop=list(sources), sources=sources)


def write_history(stage: Stage, current: DataFrame, run_ts: str, strategy: str) -> None:
    """One snapshot run of all months of a table."""
    entries = stage.seen().entries(HISTORY_TABLE)
    batch, _ = snapshot_batch(stage.spark, stage.path(HISTORY_TABLE), current, run_ts, strategy, entries)
    stage.replace(HISTORY_TABLE, batch)


def write_changed_history(stage: Stage, run_ts: str, strategy: str) -> list[datetime.date]:
    """One snapshot run of the months that were written since the last one; returns them.

    Manifests say which. A run on a table without a new commit reads no data file.
    """
    held = {part: f"{folder} {strategy}" for part, folder in stage.months_held(RAW).items()}
    history = stage.seen().entries(HISTORY_TABLE)
    lost = {part: "" for part in history if part.startswith("month=") and part not in held}
    outdated = {**stage.outdated(HISTORY_TABLE, held), **lost}
    months = monthly.months_in(outdated)
    if not months:
        return []
    # A key holds the day that its month comes from, so months are compared and rewritten by themselves.
    for run in monthly.runs(stage.spark, stage.path(RAW), months, stage.months_held(RAW)):
        current = stage.table(RAW, months=run).drop("month")
        batch, _ = snapshot_batch(
            stage.spark, stage.path(HISTORY_TABLE), current, run_ts, strategy, history, months=run if history else None
        )
        stage.replace(HISTORY_TABLE, batch)
    stage.replace(HISTORY_TABLE, None, sources={part: now for part, now in outdated.items() if now})
    return months


__all__ = ["build_models", "ingest", "model_tables", "source", "train_and_predict"]
