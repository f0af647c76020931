"""Commits over several tables, runs that are repeated, declared tables, and work that is not done twice."""

from __future__ import annotations

import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from compare import rows_of
from daygrain.operators import forecast, models, moments
from daygrain.operators.checks import STANDARD_CHECKS, CheckFailed, Checking, run_checks
from daygrain.operators.history import snapshot_scd2
from daygrain.plans import daily
from daygrain.plans.daily import build_models, ingest, train_and_predict
from daygrain.schemas import HISTORY, KEYS, METRICS, STAGE
from daygrain.session import STAGE_SETTINGS, settings
from daygrain.sources import declared, release
from daygrain.sources import months as monthly
from daygrain.sources.payloads import conform, pack_daily, series_of, write_payloads
from daygrain.sources.release import Stage, pin, source
from daygrain.sources.tables import (
    CATALOG,
    append_run,
    path_exists,
    read_history,
    read_log,
    read_observations,
    table_path,
    upsert_observations,
    write_snapshot,
)

RAW, FORECAST, FINAL = daily.RAW, daily.FORECAST_TABLE, daily.FINAL_TABLE
METRICS_TABLE, OUTCOMES, HISTORY_TABLE = daily.METRICS_TABLE, daily.OUTCOMES_TABLE, daily.HISTORY_TABLE
MODELS = ("dbt.moving_avg", "dbt.temp_anomaly", "dbt.rolling_precip", "dbt.dry_spell")


class Stop(Exception):
    """Stands for a driver that dies."""


def contents(df):
    return rows_of(df.columns, df.collect())


def days(city, first, n, rng, shift=0.0, keep=1.0):
    start = datetime.date.fromisoformat(first)
    rows = []
    for i in range(n):
        if rng.random() >= keep:
            continue
        amount = None if rng.random() < 0.1 else rng.choice([0.0, 0.0, 0.0, 1.5, 30.0])
        temp = None if rng.random() < 0.1 else float(rng.randint(-5, 30)) + shift
        rows.append((city, 1.0, 2.0, start + datetime.timedelta(days=i), temp, temp, temp, amount, 3.0, rng.randint(0, 3)))
    return rows


SCHEMA = StructType([STAGE[n] for n in STAGE.names])


def table_of(spark, rows):
    return spark.createDataFrame([dict(zip(SHORT, r)) for r in rows], SCHEMA)


SHORT = ("city", "latitude", "longitude", "date", "temp_max", "temp_min", "temp_mean", "precipitation_mm", "wind_speed_max_kmh", "weather_code")


class Site:
    """A root whose payloads and series list follow from rows."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, str(root), 0
        self.known = set()

    @property
    def series(self):
        return f"{self.root}/series"

    def land(self, rows, load_ts="2026-03-01 00:00:00"):
        self.n += 1
        batch = table_of(self.spark, rows)
        write_payloads(pack_daily(batch), f"{self.root}/landing-{self.n}")
        self.known |= {r[0] for r in rows}
        listed = self.spark.createDataFrame([(c, 1.0, 2.0) for c in sorted(self.known)], "city string, lat double, lon double")
        listed.write.mode("overwrite").json(self.series)
        ingest(self.spark, f"{self.root}/landing-{self.n}", self.series, self.root, load_ts, require_all=False, json_lines=True)

    def build(self, day=1, **how):
        return build_models(self.spark, self.root, self.series, f"2026-06-{day:02d} 00:00:00", json_lines=True, **how)

    def table(self, name):
        return source(self.spark, name, self.root)


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


# a stage is seen as a whole


@pytest.mark.parametrize("step", ["write_version", "write_run", "switch", "roll_forward", "tidy"])
def test_stage_cut_off_between_any_steps(spark, site, monkeypatch, step):
    """Cut at the first and at every later call of each step, readers see all old or all new tables."""
    rng = random.Random(1)
    site.land(days("A", "2026-01-01", 60, rng) + days("B", "2026-01-10", 5, rng))
    train_and_predict(spark, site.root, "2026-03-02 00:00:00")
    names = (FORECAST, FINAL, METRICS_TABLE, OUTCOMES)
    state = lambda: {name: contents(site.table(name)) for name in names}
    old = state()
    before = pin(spark, site.root)
    site.land(days("A", "2026-03-01", 20, rng))
    owner = {"write_version": release.tables, "write_run": release.monthly, "switch": release.monthly}.get(step, release)
    original = getattr(owner, step)
    seen = []
    for cut in range(9):
        calls = [0]

        def stop_at(*args, _cut=cut, **how):
            calls[0] += 1
            if calls[0] > _cut:
                raise Stop
            return original(*args, **how)

        with monkeypatch.context() as patch:
            patch.setattr(owner, step, stop_at)
            try:
                train_and_predict(spark, site.root, "2026-03-25 00:00:00")
            except Stop:
                seen.append(state())
            else:
                break
    train_and_predict(spark, site.root, "2026-03-25 00:00:00")
    new = state()
    assert old != new and seen
    assert all(s in (old, new) for s in seen)
    if step.startswith("write"):
        assert all(s == old for s in seen)
    # Tables read by path have caught up as well.
    for name in names:
        number, entries = monthly.manifest(spark, table_path(site.root, name))
        assert pin(spark, site.root).held[name] == (number, entries)
    assert before.number < pin(spark, site.root).number


def test_a_pinned_reader_stays_with_its_release(spark, site):
    rng = random.Random(2)
    site.land(days("A", "2026-01-01", 40, rng))
    train_and_predict(spark, site.root, "2026-03-02 00:00:00")
    held = pin(spark, site.root)
    expected = {name: contents(held.table(name)) for name in (RAW, FORECAST, FINAL, METRICS_TABLE)}
    site.land(days("A", "2026-02-05", 40, rng, shift=9.0))
    assert contents(site.table(RAW)) != expected[RAW]
    assert {name: contents(held.table(name)) for name in expected} == expected
    # A table that is written on its own counts from then on.
    batch = conform(table_of(spark, days("C", "2026-05-01", 3, rng)), STAGE)
    upsert_observations(spark, table_path(site.root, RAW), batch, "2026-06-01 00:00:00")
    assert site.table(RAW).filter("city = 'C'").count() == 3
    # And its moments follow at the next stage, though that write knew nothing of them.
    train_and_predict(spark, site.root, "2026-06-02 00:00:00")
    assert {r.series for r in site.table(OUTCOMES).collect()} == {"A", "C"}


def test_two_stages_at_once(spark, site):
    site.land(days("A", "2026-01-01", 5, random.Random(1)))
    first, second = Stage(spark, site.root), Stage(spark, site.root)
    rows = spark.createDataFrame([("A", "MAE", 1.0)], "series string, error_metric string, metric_value double")
    first.log(METRICS_TABLE, rows, "2026-03-01 00:00:00")
    second.log(METRICS_TABLE, rows, "2026-03-02 00:00:00")
    first.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        second.commit()
    assert site.table(METRICS_TABLE).count() == 1


def test_files_of_old_releases_go(spark, site):
    rng = random.Random(3)
    site.land(days("A", "2026-01-01", 40, rng))
    for day in range(1, 5):
        train_and_predict(spark, site.root, f"2026-03-0{day} 00:00:00")
    path = table_path(site.root, FORECAST)
    assert len([f for f in monthly.children(spark, path) if f.startswith("version-")]) == 2
    assert len(monthly.children(spark, f"{site.root}/_release/_manifest")) == release.KEPT_RELEASES
    assert site.table(METRICS_TABLE).select("run_ts").distinct().count() == 4


def test_failing_check_leaves_the_models_in_place(spark, site):
    rng = random.Random(4)
    site.land(days("A", "2026-01-01", 40, rng))
    site.build(1)
    old = {name: contents(site.table(name)) for name in (*MODELS, HISTORY_TABLE)}
    site.land(days("A", "2026-02-01", 20, rng) + days("Stranger", "2026-02-01", 9, rng))
    spark.createDataFrame([("A", 1.0, 2.0)], "city string, lat double, lon double").write.mode("overwrite").json(site.series)
    for incremental in (False, True):
        with pytest.raises(CheckFailed, match="accepted_values"):
            site.build(2, incremental=incremental)
        assert {name: contents(site.table(name)) for name in old} == old
    spark.createDataFrame([("A", 1.0, 2.0), ("Stranger", 1.0, 2.0)], "city string, lat double, lon double").write.mode(
        "overwrite"
    ).json(site.series)
    assert {r.failures for r in site.build(3).collect()} == {0}
    assert all(contents(site.table(name)) != old[name] for name in old)


# runs


def test_a_repeated_run_is_logged_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    rows = lambda *v: spark.createDataFrame(
        [("A", "MAE", x) for x in v], "series string, error_metric string, metric_value double"
    )
    append_run(rows(1.0, 2.0), path, "2026-03-01 00:00:00")
    append_run(rows(3.0), path, "2026-03-02 00:00:00")
    append_run(rows(4.0), path, "2026-03-01 00:00:00")
    held = lambda: sorted((r.run_ts.day, r.metric_value) for r in read_log(spark, path, METRICS).collect())
    assert held() == [(1, 4.0), (2, 3.0)]
    with monkeypatch.context() as cut:
        cut.setattr(monthly, "switch", lambda *_: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            append_run(rows(5.0), path, "2026-03-03 00:00:00")
    assert held() == [(1, 4.0), (2, 3.0)]
    append_run(rows().limit(0), path, "2026-03-02 00:00:00")
    assert held() == [(1, 4.0)]


def test_every_series_is_fitted_or_has_a_reason(spark, site):
    rng = random.Random(5)
    full = [(*r[:4], 20.0 + i % 3, *r[5:]) for i, r in enumerate(days("long", "2026-01-01", 30, rng))]
    some = [(*r[:4], 1.0, *r[5:]) for r in days("twelve", "2026-01-01", 12, rng)]
    few = [(*r[:4], 1.0, *r[5:]) for r in days("few", "2026-01-01", 3, rng)]
    none = [(*r[:4], None, *r[5:]) for r in days("none", "2026-01-01", 20, rng)]
    site.land(full + some + few + none)
    for _ in range(2):
        train_and_predict(spark, site.root, "2026-03-02 00:00:00")
    got = {r.series: r for r in site.table(OUTCOMES).collect()}
    assert site.table(OUTCOMES).count() == 4  # logged once
    assert {s: (r.n_rows, r.n, r.fitted, r.fit_reason, r.scored, r.score_reason) for s, r in got.items()} == {
        "long": (30, 30, True, None, True, None),
        "twelve": (12, 12, True, None, False, "too few before the holdout"),
        "few": (3, 3, False, "too few rows", False, "too few rows"),
        "none": (20, 0, False, "no values", False, "no values"),
    }
    assert {r.series for r in site.table(FORECAST).select("series").distinct().collect()} == {"long", "twelve"}
    assert {r.series for r in site.table(METRICS_TABLE).select("series").distinct().collect()} == {"long"}
    same_day = spark.createDataFrame([("S", datetime.date(2026, 1, 1), float(i)) for i in range(20)], "city string, date date, temp_max double")
    assert forecast.fit_outcomes(moments.month_moments(same_day)).first().fit_reason == "one day"


# moments


def test_moments_give_what_the_rows_give(spark):
    rng = random.Random(6)
    rows = [r for c in "ABCDE" for r in days(c, "2025-01-15", 400, rng, keep=rng.choice([1.0, 0.4, 0.04]))]
    table = table_of(spark, rows)
    per_month = moments.month_moments(table)
    for direct, stored in (
        (forecast.predict(forecast.fit_trend(table)), forecast.predict(forecast.fit_moments(per_month))),
        (forecast.evaluate(table), forecast.evaluate_moments(per_month)),
    ):
        rounded = lambda df: contents(
            df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
        )
        assert rounded(direct) == rounded(stored)
    with pytest.raises(ValueError, match="too few for a holdout"):
        forecast.evaluate_moments(per_month, holdout=8)


def test_a_fit_reads_no_fact_row(spark, site, monkeypatch):
    site.land(days("A", "2026-01-01", 60, random.Random(7)))
    seen = []
    original = monthly.read

    def read(session, path, schema, *args, **how):
        seen.append((path.rsplit("/", 1)[-1], args[0] if args else how.get("months")))
        return original(session, path, schema, *args, **how)

    monkeypatch.setattr(monthly, "read", read)
    stage = Stage(spark, site.root)
    assert daily.renew_moments(stage) == []
    model = forecast.fit_moments(stage.table(daily.MOMENTS_TABLE, months=[datetime.date(2026, 1, 1), datetime.date(2026, 2, 1), datetime.date(2026, 3, 1)]))
    files = model.inputFiles()
    assert files and all("city_weather_moments" in f for f in files)
    assert "city_weather" not in {name for name, _ in seen}
    site.land(days("A", "2026-03-01", 3, random.Random(8)))
    touched = [m for name, m in seen if name == "city_weather" and m is not None]
    assert all(set(m) <= {datetime.date(2026, 3, 1)} for m in touched) and touched


# models month by month


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_models_equal_full_ones(spark, tmp_path, seed):
    """Random batches, corrections and new series: after each, the models are those of a full rebuild."""
    rng = random.Random(seed)
    site = Site(spark, tmp_path)
    batches = [
        days("dense", "2025-11-20", 70, rng) + days("thin", "2025-10-01", 120, rng, keep=0.1),
        days("dense", "2026-01-29", 30, rng) + days("late", "2026-02-10", 5, rng),
        days("dense", "2026-01-10", 3, rng, shift=50.0) + days("old", "2025-12-05", 40, rng, keep=0.5),
        days("thin", "2026-04-20", 2, rng),
    ]
    for number, batch in enumerate(rng.sample(batches, len(batches)) if seed > 1 else batches, 1):
        site.land(batch)
        site.build(number, incremental=True)
        raw = site.table(RAW)
        for name, model in (("moving_avg", models.moving_avg), ("rolling_precip", models.rolling_precip),
                            ("dry_spell", models.dry_spell), ("temp_anomaly", models.temp_anomaly)):
            assert contents(site.table(f"dbt.{name}")) == contents(model(raw)), name
    # The carry as of every month is the one a full build gives.
    stored = contents(site.table(daily.CARRY_TABLE).withColumn("temps", F.to_json("temps")).withColumn("rain", F.to_json("rain")))
    whole = Site(spark, f"{tmp_path}/whole")
    whole.land([tuple(r) for r in site.table(RAW).select(*SHORT).collect()])
    whole.build(9, incremental=True)
    again = whole.table(daily.CARRY_TABLE).withColumn("temps", F.to_json("temps")).withColumn("rain", F.to_json("rain"))
    assert stored == contents(again)


def test_runs_of_months_give_the_tables_of_one_run(spark, tmp_path, monkeypatch):
    """A run at a time: models, carry, history and counts of the checks are those of all months at once."""
    tables = {}
    for at_most in (1, 1 << 30):
        rng, runs = random.Random(11), []
        monkeypatch.setattr(monthly, "RUN_BYTES", at_most)
        carry = daily.carry_over
        with monkeypatch.context() as patch:
            patch.setattr(daily, "carry_over", lambda *a: (runs.append(len(a[2])), carry(*a))[1])
            site = Site(spark, tmp_path / str(at_most))
            site.land(days("dense", "2025-11-20", 70, rng) + days("thin", "2025-10-01", 120, rng, keep=0.1))
            results = [site.build(1, incremental=True, strategy="check")]
            site.land(days("dense", "2026-01-29", 60, rng, shift=9.0) + days("late", "2026-02-10", 5, rng))
            results.append(site.build(2, incremental=True, strategy="check"))
        shown = [site.table(name) for name in (*MODELS, HISTORY_TABLE)]
        shown.append(site.table(daily.CARRY_TABLE).withColumn("temps", F.to_json("temps")).withColumn("rain", F.to_json("rain")))
        tables[at_most] = [contents(df) for df in (*results, *shown)]
        months = len(monthly.months_in(monthly.manifest(spark, table_path(site.root, RAW))[1]))
        assert set(runs) == {1} if at_most == 1 else max(runs) > 1 and len(runs) == 2
        assert months == 6
    assert tables[1] == tables[1 << 30]


def test_checks_of_a_table_written_in_parts_add_up(spark, tmp_path):
    checking = Checking("city_weather", STANDARD_CHECKS["city_weather"], ["A"])
    rows = spark.createDataFrame([(None, None), ("A", None), ("A", datetime.date(2026, 1, 1))], "city string, date date")
    for part in range(3):
        checking.watch(rows).write.parquet(str(tmp_path / str(part)))
    assert [n for *_, n in checking.found()] == [3, 6]


def test_a_stage_leaves_no_shuffle_files(spark, site):
    """Shuffle files go with their job, not when the driver collects its garbage."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        blocks = disk.getAllBlocks().mkString(" ").split()
        return {b for b in blocks if b.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting)
    rng = random.Random(12)
    batch = days("A", "2026-01-01", 40, rng) + days("B", "2026-01-20", 40, rng)
    spark.createDataFrame([(c, 1.0, 2.0) for c in "AB"], "city string, lat double, lon double").write.json(site.series)
    with settings(spark, STAGE_SETTINGS):
        write_payloads(pack_daily(table_of(spark, batch)), f"{site.root}/landing")
    ingest(spark, f"{site.root}/landing", site.series, site.root, "2026-03-01 00:00:00", json_lines=True)
    train_and_predict(spark, site.root, "2026-03-02 00:00:00")
    site.build(1, incremental=True)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert shuffled() - before == set()
    assert spark.conf.get(setting) == was


def test_stored_files_are_compressed(spark, site):
    site.land(days("A", "2026-01-01", 40, random.Random(13)))
    site.build(1, incremental=True)
    stored = [f for _, _, names in os.walk(site.root) for f in names if f.startswith("part-") and f.endswith(".parquet")]
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)
    landed = [f for f in os.listdir(f"{site.root}/landing-1") if f.startswith("part-")]
    assert landed and all(f.endswith(".json.gz") for f in landed)


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_only_months_of_a_history_are_joined(spark, tmp_path, monkeypatch, strategy):
    """Months that the history lacks hold new rows alone, so no join is made for them."""
    rng, path, joined = random.Random(14), str(tmp_path / "history"), []
    early, late = days("A", "2026-01-05", 40, rng), days("A", "2026-02-01", 60, rng, shift=3.0)
    write_snapshot(spark, path, table_of(spark, early), "2026-06-01 00:00:00", strategy)
    original = snapshot_scd2

    def watched(history, current, *args, **how):
        if history is not None:
            joined.extend(r.month for r in current.selectExpr("month(date) AS month").distinct().collect())
        return original(history, current, *args, **how)

    monkeypatch.setattr(release.tables, "snapshot_scd2", watched)
    now = [r for r in early if r[3].month == 1] + late
    write_snapshot(spark, path, table_of(spark, now), "2026-06-02 00:00:00", strategy)
    assert joined == [2]
    first = original(None, table_of(spark, early), "2026-06-01 00:00:00", strategy)
    expected = original(first, table_of(spark, now), "2026-06-02 00:00:00", strategy)
    assert contents(read_history(spark, path)) == contents(expected)


def test_incremental_build_reads_touched_months_only(spark, site, monkeypatch):
    rng = random.Random(9)
    site.land(days("A", "2025-11-01", 120, rng))
    site.build(1, incremental=True)
    kept = {name: monthly.manifest(spark, table_path(site.root, name))[1] for name in MODELS}
    site.land(days("A", "2026-02-20", 20, rng))
    seen = []
    original = monthly.read

    def read(session, path, schema, months=None, *args, **how):
        if path.endswith("raw/city_weather"):
            seen.append(None if months is None else sorted(months))
        return original(session, path, schema, months, *args, **how)

    with monkeypatch.context() as patch:
        patch.setattr(monthly, "read", read)
        monkeypatch.setattr(daily, "temp_anomaly", lambda raw, **_: models.temp_anomaly(raw))
        site.build(2, incremental=True)
    february, march = datetime.date(2026, 2, 1), datetime.date(2026, 3, 1)
    assert [s for s in seen if s is not None] == [[february, march]] * 2  # the models, and the history
    for name in ("dbt.moving_avg", "dbt.rolling_precip", "dbt.dry_spell"):
        now = monthly.manifest(spark, table_path(site.root, name))[1]
        same = {part for part in now if part.startswith("month=") and now[part] == kept[name].get(part)}
        assert same == {"month=2025-11-01", "month=2025-12-01", "month=2026-01-01"}
    # Nothing new: nothing is built, compared or written.
    number = {name: monthly.manifest(spark, table_path(site.root, name))[0] for name in (*MODELS, HISTORY_TABLE)}
    seen.clear()
    with monkeypatch.context() as patch:
        patch.setattr(monthly, "read", read)
        site.build(3, incremental=True)
    assert [s for s in seen if s is not None] == []
    assert number == {name: monthly.manifest(spark, table_path(site.root, name))[0] for name in number}


def test_plans_without_blocks_only(spark):
    rows = table_of(spark, days("A", "2026-01-01", 3, random.Random(1)))
    with pytest.raises(ValueError, match="without blocks"):
        models.moving_avg(rows, block_days=2, before=rows.select("city", "date", *models.TEMPERATURES))
    with pytest.raises(ValueError, match="without blocks"):
        models.dry_spell(rows, block_days=2, before=rows)


# checks


def test_checks_are_taken_while_writing(spark, tmp_path):
    rows = [("A", "Wet"), ("B", None), (None, "odd"), ("Z", "Dry Period")]
    df = spark.createDataFrame(rows, "city string, label string").repartition(3)
    from daygrain.operators.checks import TableChecks, SERIES_LIST

    checks = TableChecks(not_null=("city", "label"), accepted={"city": SERIES_LIST, "label": ("Wet", "Dry Period")})
    known = spark.createDataFrame([("A",), ("B",), ("B",)], "name string")
    for series_list in (known.distinct(), ("A", "B")):
        watched = Checking("t", checks, series_list)
        out = str(tmp_path / f"out{type(series_list).__name__}")
        watched.watch(df).write.parquet(out)
        assert contents(spark.read.parquet(out)) == contents(df)
        expected = {("t", "city", "not_null", 1), ("t", "label", "not_null", 1), ("t", "city", "accepted_values", 1), ("t", "label", "accepted_values", 1)}
        assert set(watched.found()) == expected
        assert {tuple(r) for r in run_checks({"t": df}, {"t": checks}, series_list).collect()} == expected
    empty = Checking("t", checks, known.distinct())
    empty.watch(df.limit(0)).write.parquet(str(tmp_path / "none"))
    assert [n for *_, n in empty.found()] == [0, 0, 0, 0]


def test_standing_alone_checks_scan_each_table_once(spark, data_dir, tmp_path):
    from daygrain.plans.daily import model_tables
    from daygrain.sources.bindings import daily_obs

    raw_path = str(tmp_path / "raw")
    upsert_observations(spark, raw_path, conform(daily_obs(spark, data_dir), STAGE), "2024-02-01 00:00:00")
    raw = read_observations(spark, raw_path)
    tables = {**model_tables(raw), "city_weather": raw}
    known = spark.createDataFrame([("S_1",)], "city string")
    text = run_checks(tables, series_list=known)._jdf.queryExecution().optimizedPlan().toString()
    assert set(STANDARD_CHECKS) == set(tables)
    # The anomalies compare rows with their series' average inside one scan as well.
    assert text.count("Relation [") == len(tables)


# history


def test_missing_keys_do_not_grow_the_history(spark, tmp_path):
    day = datetime.date(2026, 3, 4)
    rows = [("A", day, 1.0), (None, day, 2.0), ("A", None, 3.0), (None, None, 4.0)]
    state = lambda shift=0.0: spark.createDataFrame(
        [{"city": c, "date": d, "temp_max": t + (shift if c is None else 0.0)} for c, d, t in rows],
        StructType([StructField(f.name, f.dataType, True) for f in STAGE.fields]),
    )
    for strategy in ("timestamp", "check"):
        path = str(tmp_path / strategy)
        history = None
        for run in range(1, 4):
            run_ts = f"2026-06-0{run} 00:00:00"
            history = snapshot_scd2(history, state(), run_ts, strategy)
            assert history.count() == 4
            write_snapshot(spark, path, state(), run_ts, strategy)
            assert contents(read_history(spark, path)) == contents(history)
        assert monthly.manifest(spark, path)[0] == 1  # nothing changed, nothing was committed
        history = snapshot_scd2(history, state(5.0), "2026-06-09 00:00:00", strategy)
        write_snapshot(spark, path, state(5.0), "2026-06-09 00:00:00", strategy)
        assert history.count() == (6 if strategy == "check" else 4)
        assert contents(read_history(spark, path)) == contents(history)
        gone = state(5.0).filter("city IS NOT NULL")
        write_snapshot(spark, path, gone, "2026-06-10 00:00:00", strategy)
        history = snapshot_scd2(history, gone, "2026-06-10 00:00:00", strategy)
        assert contents(read_history(spark, path)) == contents(history)
        assert history.filter("valid_to IS NULL").count() == 2


def test_stored_history_follows_only_new_commits(spark, site, monkeypatch):
    rng = random.Random(10)
    rows = days("A", "2026-01-01", 70, rng)
    site.land(rows)
    site.build(1, strategy="check")
    expected = snapshot_scd2(None, site.table(RAW), "2026-06-01 00:00:00", "check")
    assert contents(site.table(HISTORY_TABLE)) == contents(expected)
    compared = []
    original = release.tables.snapshot_batch
    monkeypatch.setattr(daily, "snapshot_batch", lambda *a, **how: (compared.append(how["months"]), original(*a, **how))[1])
    site.build(2, strategy="check")
    assert compared == []  # no commit since, so no file is compared
    site.land([(*r[:4], 99.0, *r[5:]) for r in rows[-3:]])
    before = contents(site.table(RAW))
    site.build(3, strategy="check")
    assert compared == [[datetime.date(2026, 3, 1)]]
    expected = snapshot_scd2(expected, site.table(RAW), "2026-06-03 00:00:00", "check")
    assert contents(site.table(HISTORY_TABLE)) == contents(expected) and contents(site.table(RAW)) == before
    # Another strategy compares everything again.
    site.build(4, strategy="timestamp")
    assert len(compared[-1]) == 3
    assert site.table(HISTORY_TABLE).columns == HISTORY.names


# declared tables

LEDGER = declared.Declaration(
    StructType([StructField("city", StringType()), StructField("date", STAGE["date"].dataType), StructField("x", DoubleType()), StructField("n", LongType())]),
    key=KEYS,
    not_null=("x",),
    defaults={"n": "1 + 1"},
)


def test_declared_table_fills_and_refuses(spark, tmp_path):
    path = str(tmp_path / "t")
    declared.declare(spark, path, LEDGER)
    assert declared.declaration(spark, path) == declared.Declaration(LEDGER.schema, list(KEYS), ["x"], {"n": "1 + 1"})
    day = lambda n: datetime.date(2026, 3, 1) + datetime.timedelta(days=n)
    rows = lambda *r: spark.createDataFrame(list(r), "date date, city string, x int, n int")
    monthly.write(rows((day(0), "A", 1, None), (day(1), "A", 2, 7)), path)
    held = lambda: sorted(tuple(r) for r in monthly.read(spark, path, LEDGER.schema).drop("month").collect())
    assert held() == [("A", day(0), 1.0, 2), ("A", day(1), 2.0, 7)]
    for bad, message in (
        (rows((day(0), "A", 1, 1), (day(0), "A", 2, 1)), "repeated key"),
        (rows((day(0), None, 1, 1)), "missing values"),
        (rows((day(0), "A", None, 1)), "missing values"),
        (rows((day(0), "A", 1, 1)).drop("x"), "missing values"),
        (rows((day(0), "A", 1, 1)).withColumn("y", F.lit(1)), "does not have"),
    ):
        with pytest.raises(CheckFailed, match=message):
            monthly.write(bad, path)
        assert held() == [("A", day(0), 1.0, 2), ("A", day(1), 2.0, 7)]
    monthly.write(rows((day(0), "B", 5, 5)).drop("n"), path)
    assert held() == [("B", day(0), 5.0, 2)]
    with pytest.raises(ValueError, match="not in the schema"):
        declared.Declaration(LEDGER.schema, key=("nothing",))


def test_declaration_stays_and_holds_for_every_writer(spark, site, tmp_path):
    site.land(days("A", "2026-01-01", 5, random.Random(1)))
    path = table_path(site.root, RAW)
    assert declared.declaration(spark, path).key == list(KEYS)
    row = table_of(spark, days("A", "2026-01-01", 1, random.Random(2)))
    with pytest.raises(CheckFailed, match="repeated key"):
        monthly.write(row.union(row), path)
    # A load time that is not given is now.
    start = datetime.datetime.now() - datetime.timedelta(days=1)
    monthly.write(row, path)
    assert site.table(RAW).first().load_ts > start
    declared.declare(spark, path, LEDGER)
    assert declared.declaration(spark, path).key == list(KEYS) and "x" not in declared.declaration(spark, path).schema.names
    declared.declare(spark, path, LEDGER, replace=True)
    assert declared.declaration(spark, path).not_null == ["x"]
    from daygrain.sources.tables import current_version, publish

    version = str(tmp_path / "v")
    declared.declare(spark, version, LEDGER)
    with pytest.raises(CheckFailed, match="repeated key"):
        publish(spark.createDataFrame([("A", None, 1.0)] * 2, "city string, date date, x double").fillna({"x": 1}).withColumn("date", F.lit(datetime.date(2026, 1, 1))), version)
    assert current_version(spark, version) is None and not path_exists(spark, version)


def test_every_named_table_has_a_schema():
    assert set(release.tables.BY_MONTH) | set(release.tables.BY_RUN) <= set(CATALOG)
