"""The three stages on files, end to end, and what happens when one fails."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from daygrain.operators.checks import CheckFailed, TableChecks, check_accepted, check_not_null, run_checks
from daygrain.operators.history import snapshot_scd2
from daygrain.plans.daily import build_models, ingest, train_and_predict
from daygrain.schemas import FINAL, METRICS, MOVING_AVG
from daygrain.sources import bucketed, months
from daygrain.sources.release import source
from daygrain.sources.tables import (
    append_run,
    create_database,
    create_if_absent,
    current_version,
    describe_table,
    drop_old_versions,
    load,
    path_exists,
    publish,
    read_history,
    read_log,
    read_observations,
    table_path,
    upsert_observations,
    write_snapshot,
)
from daygrain.streaming.landing import ingest_landed

CITIES = [
    {"city": "Saltmarsh Point", "lat": 31.25, "lon": -110.5},
    {"city": "Northmere", "lat": 44.75, "lon": -69.25},
    {"city": "Fernhaven", "lat": 48.5, "lon": -121.75},
    {"city": "Palmreach", "lat": 26.125, "lon": -81.5},
]
RAW = "raw.city_weather"


def payload(city, start, days, shift=0.0):
    first = datetime.date.fromisoformat(start)
    k = len(city)
    at = range(days)
    return {
        "city": city,
        "daily": {
            "time": [(first + datetime.timedelta(days=i)).isoformat() for i in at],
            "temperature_2m_max": [15.0 + (i * k) % 7 + shift for i in at],
            "temperature_2m_min": [5.0 + (i * k) % 5 for i in at],
            "temperature_2m_mean": [10.0 + (i * k) % 3 for i in at],
            "precipitation_sum": [None if i == 3 else float((i * k) % 4) for i in at],
            "windspeed_10m_max": [20.0 for _ in at],
            "weathercode": [(0, 3, 61)[i % 3] for i in at],
        },
    }


def land(folder, name, payloads):
    os.makedirs(folder, exist_ok=True)
    for p in payloads:
        with open(os.path.join(folder, f"{name}-{p['city'].replace(' ', '_')}.json"), "w") as f:
            json.dump(p, f)


@pytest.fixture
def site(tmp_path):
    series = tmp_path / "series.json"
    series.write_text(json.dumps(CITIES, indent=1))
    return str(tmp_path), str(series)


def contents(df):
    return rows_of(df.columns, df.collect())


def test_three_stages(spark, site):
    root, series = site
    land(f"{root}/landing", "a", [payload(c["city"], "2026-01-20", 60) for c in CITIES])
    ingest(spark, f"{root}/landing", series, root, "2026-03-21 02:30:00")
    raw = source(spark, RAW, root)
    assert raw.count() == 240
    assert raw.filter("city = 'Northmere'").select("latitude").distinct().first()[0] == 44.75
    before = contents(raw)

    # The same payloads again change nothing, load times included.
    ingest(spark, f"{root}/landing", series, root, "2026-03-22 02:30:00")
    assert contents(source(spark, RAW, root)) == before

    train_and_predict(spark, root, "2026-03-21 03:30:00")
    train_and_predict(spark, root, "2026-03-22 03:30:00")
    assert spark.table("city_weather_train_view").columns == ["city", "date", "temp_max"]
    final = load(spark, table_path(root, "analytics.city_weather_final"), FINAL)
    assert final.count() == 240 + 4 * 7
    assert final.filter("actual IS NULL").agg(F.min("date")).first()[0] == datetime.date(2026, 3, 21)
    metrics = source(spark, "analytics.city_weather_model_metrics", root)
    assert metrics.count() == 2 * 4 * 5

    results = build_models(spark, root, series, "2026-03-21 04:30:00")
    assert results.count() == 30
    counts = {
        name: source(spark, f"dbt.{name}", root).count()
        for name in ("moving_avg", "temp_anomaly", "rolling_precip", "dry_spell")
    }
    assert counts == {"moving_avg": 240, "temp_anomaly": 240, "rolling_precip": 236, "dry_spell": 236}
    assert source(spark, "dbt.city_weather_snapshot", root).count() == 240
    build_models(spark, root, series, "2026-03-22 04:30:00")
    assert source(spark, "dbt.city_weather_snapshot", root).count() == 240


def test_three_stages_on_a_bucketed_table(spark, site):
    root, series = site
    name = "weather_bucketed"
    bucketed.register(spark, name, f"{root}/bucketed", buckets=4)
    try:
        land(f"{root}/one", "a", [payload(c["city"], "2026-01-20", 40) for c in CITIES])
        land(f"{root}/two", "b", [payload(c["city"], "2026-02-10", 40, shift=1.0) for c in CITIES])
        for landing, day in (("one", 1), ("two", 22)):
            load_ts = f"2026-03-{day:02d} 02:30:00"
            ingest(spark, f"{root}/{landing}", series, root, load_ts, bucketed_table=name)
            ingest(spark, f"{root}/{landing}", series, f"{root}/plain", load_ts)
        table = bucketed.read(spark, name)
        assert contents(table) == contents(source(spark, RAW, f"{root}/plain"))
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
        # One file per bucket and month at most.
        held = months.manifest(spark, f"{root}/bucketed")[1]
        assert set(held) == {"month=2026-01-01", "month=2026-02-01", "month=2026-03-01"}
        for month, batch in held.items():
            files = os.listdir(f"{root}/bucketed/{batch}/{month}")
            assert 0 < len([f for f in files if f.endswith(".parquet")]) <= 4

        train_and_predict(spark, root, "2026-03-22 03:30:00", bucketed_table=name)
        assert build_models(spark, root, series, "2026-03-22 04:30:00", bucketed_table=name).count() == 30

        # The catalog entry is only a name for the files.
        before = contents(table)
        bucketed.drop(spark, name)
        bucketed.register(spark, name, f"{root}/bucketed", buckets=4)
        assert contents(bucketed.read(spark, name)) == before
    finally:
        bucketed.drop(spark, name)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]


def test_failing_check_stops_before_the_snapshot(spark, site):
    root, series = site
    stranger = {"city": "Oslo", "lat": 59.9, "lon": 10.7}
    land(f"{root}/landing", "a", [payload("Oslo", "2026-01-20", 12)])
    with open(f"{root}/all.json", "w") as f:
        json.dump([*CITIES, stranger], f)
    ingest(spark, f"{root}/landing", f"{root}/all.json", root, "2026-03-21 02:30:00", require_all=False)
    with pytest.raises(CheckFailed, match="accepted_values"):
        build_models(spark, root, series, "2026-03-21 04:30:00")
    assert not path_exists(spark, table_path(root, "dbt.city_weather_snapshot"))


def test_only_touched_months_are_rewritten(spark, site):
    root, series = site
    table = table_path(root, RAW)
    land(f"{root}/one", "a", [payload("Northmere", "2026-01-01", 59)])
    ingest(spark, f"{root}/one", series, root, "2026-03-01 00:00:00", require_all=False)
    january = months.manifest(spark, table)[1]["month=2026-01-01"]
    land(f"{root}/two", "b", [payload("Northmere", "2026-02-10", 30, shift=1.0)])
    ingest(spark, f"{root}/two", series, root, "2026-03-12 00:00:00", require_all=False)
    assert months.manifest(spark, table)[1]["month=2026-01-01"] == january
    rows = read_observations(spark, table).orderBy("date").collect()
    assert len(rows) == 59 + 11  # January and February, then 1 to 11 March
    changed = [r for r in rows if r.date >= datetime.date(2026, 2, 10)]
    assert {r.load_ts.date().isoformat() for r in changed} == {"2026-03-01", "2026-03-12"}
    assert changed[0].temp_max == 16.0 and rows[0].temp_max == 15.0


def test_failed_merge_leaves_the_table(spark, site):
    root, series = site
    land(f"{root}/one", "a", [payload("Northmere", "2026-01-01", 10)])
    ingest(spark, f"{root}/one", series, root, "2026-03-01 00:00:00", require_all=False)
    before = contents(source(spark, RAW, root))
    broken = payload("Northmere", "2026-01-01", 10, shift=5.0)
    broken["daily"]["weathercode"].pop()
    land(f"{root}/two", "b", [broken])
    with pytest.raises(Exception, match="shorter than time"):
        ingest(spark, f"{root}/two", series, root, "2026-03-02 00:00:00", require_all=False)
    assert contents(source(spark, RAW, root)) == before


def test_a_listed_series_without_payload_stops_the_load(spark, site):
    root, series = site
    land(f"{root}/landing", "a", [payload(c["city"], "2026-01-20", 3) for c in CITIES[:3]])
    land(f"{root}/landing", "b", [payload("Elsewhere", "2026-01-20", 3), payload("Palmreach", "2026-01-20", 0)])
    with pytest.raises(CheckFailed, match="no payload for listed series: Palmreach"):
        ingest(spark, f"{root}/landing", series, root, "2026-03-01 00:00:00")
    assert not path_exists(spark, table_path(root, RAW))
    ingest(spark, f"{root}/landing", series, root, "2026-03-01 00:00:00", require_all=False)
    cities = {r.city for r in source(spark, RAW, root).select("city").distinct().collect()}
    assert cities == {c["city"] for c in CITIES[:3]}  # nothing of an unlisted series


def test_error_while_writing_leaves_the_table(spark, site, observations):
    root, _ = site
    table = f"{root}/t"
    from daygrain.schemas import STAGE
    from daygrain.sources.payloads import conform

    good = conform(observations({"day": 1, "temp_max": 1.0}), STAGE)
    upsert_observations(spark, table, good, "2026-03-02 00:00:00")
    before = contents(read_observations(spark, table))
    # The key checks pass; only evaluating the value fails, inside the write.
    bad = good.withColumn("temp_max", F.raise_error(F.lit("no value")).cast("double"))
    with pytest.raises(Exception, match="no value"):
        upsert_observations(spark, table, bad, "2026-03-03 00:00:00")
    assert contents(read_observations(spark, table)) == before


class Stop(Exception):
    """Stands for a driver that dies."""


@pytest.mark.parametrize("step", ["commit", "switch", "tidy"])
@pytest.mark.parametrize("kind", ["fact", "bucketed", "history"])
def test_commit_cut_off_at_any_step(spark, tmp_path, observations, monkeypatch, step, kind):
    from daygrain.schemas import STAGE
    from daygrain.sources.payloads import conform

    first = [{"day": d, "temp_max": float(d)} for d in range(1, 60)]
    second = [{"day": d, "temp_max": 100.0 + d} for d in range(20, 40)]  # March and April
    whole = [r for r in first if not 20 <= r["day"] < 40] + second
    name = f"cut_{step}"

    def run(path, rows, day):
        moment = f"2026-06-{day:02d} 00:00:00"
        if kind == "history":
            write_snapshot(spark, path, observations(*(whole if day > 1 else first)), moment, "check")
        elif kind == "fact":
            upsert_observations(spark, path, conform(observations(*rows), STAGE), moment)
        else:
            bucketed.upsert_bucketed(spark, name, conform(observations(*rows), STAGE), moment)

    def stored(path):
        if kind == "bucketed":
            return contents(bucketed.read(spark, name))
        return contents(read_history(spark, path) if kind == "history" else read_observations(spark, path))

    def start(path):
        if kind == "bucketed":
            bucketed.drop(spark, name)
            bucketed.register(spark, name, path, buckets=2)
        run(path, first, 1)

    try:
        plain = str(tmp_path / "plain")
        start(plain)
        run(plain, second, 2)
        expected = stored(plain)

        path = str(tmp_path / "cut")
        start(path)
        before = stored(path)

        def stop(*_, **__):
            raise Stop

        with monkeypatch.context() as cut:
            cut.setattr(months, step, stop)
            with pytest.raises(Stop):
                run(path, second, 2)
        # Until the manifest is in place readers have the old table, from then on the new one.
        assert stored(path) == (expected if step == "tidy" else before)
        run(path, second, 2)
        assert stored(path) == expected
        held = {batch for batch in os.listdir(path) if batch.startswith("batch=")}
        kept = months.kept_entries(spark, path, months.KEPT_COMMITS)
        # A history that is already up to date makes no commit, so nothing is tidied.
        assert held == set(kept.values()) or (kind, step) == ("history", "tidy")
    finally:
        if kind == "bucketed":
            bucketed.drop(spark, name)


def test_a_second_writer_is_refused(spark, tmp_path, observations):
    path = str(tmp_path / "t")
    months.write(observations({"day": 1}), path)
    batch = months.write_batch(observations({"day": 2}), path, ("city",))
    months.write(observations({"day": 3}), path)
    with pytest.raises(RuntimeError, match="another writer"):
        months.switch(spark, path, 2, {"month=2026-03-01": batch})


def test_failed_publish_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    first = publish(df, path)
    with pytest.raises(Exception, match="stop here"):
        publish(df.withColumn("x", F.raise_error(F.lit("stop here")).cast("long")), path)
    assert current_version(spark, path) == first
    assert load(spark, path, df.schema).count() == 10
    second = publish(df.limit(3), path)
    assert current_version(spark, path) == second != first
    assert load(spark, path, df.schema).count() == 3
    assert load(spark, path, df.schema).columns == ["id", "x"]
    third = publish(df, path)
    gone = drop_old_versions(spark, path, keep=1)
    assert {first, second} < set(gone)  # and the folder of the build that failed
    assert sorted(os.listdir(path)) == ["_manifest", os.path.basename(third)]
    assert current_version(spark, path) == third


def test_publish_by_month_prunes_date_ranges(spark, tmp_path, observations):
    path = str(tmp_path / "t")
    df = observations(*[{"day": d, "temp_max": float(d)} for d in range(1, 70)])
    version = publish(df, path, sort_by=("city", "date"), by_month=True)
    assert sorted(m for m in os.listdir(version) if "=" in m) == [
        "month=2026-03-01",
        "month=2026-04-01",
        "month=2026-05-01",
    ]
    assert contents(load(spark, path, df.schema)) == contents(df)
    part = load(spark, path, df.schema, "2026-04-02", "2026-04-30")
    assert part.count() == 29 and part.columns == df.columns
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "month" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert len(part.inputFiles()) >= 1
    # A table stored otherwise gives the same rows, without pruning.
    publish(df, path)
    assert contents(load(spark, path, df.schema, "2026-04-02", "2026-04-30")) == contents(part)


def test_stored_history_rewrites_only_changed_months(spark, tmp_path, observations):
    path = str(tmp_path / "history")
    days = [{"day": d, "temp_max": float(d)} for d in (1, 40, 70)]  # March, April, May
    corrected = [{**days[0], "temp_max": 9.0}, *days[1:]]
    states = [days, days, corrected, corrected[:2], corrected]
    months, expected = [], None
    for run, state in enumerate(states, start=1):
        run_ts = f"2026-06-{run:02d} 00:00:00"
        written = write_snapshot(spark, path, observations(*state), run_ts, "check")
        months.append([m.month for m in written])
        expected = snapshot_scd2(expected, observations(*state), run_ts, "check")
        assert contents(read_history(spark, path)) == contents(expected)
    assert months == [[], [], [3], [5], [5]]


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "none"), MOVING_AVG)
    with pytest.raises(KeyError, match="unknown table"):
        table_path(str(tmp_path), "raw.other")


def test_append_log_and_empty_create(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("A", "MAE", 1.0)], "series string, error_metric string, metric_value double")
    append_run(rows, path, "2026-03-01 00:00:00")
    append_run(rows, path, "2026-03-02 00:00:00")
    create_if_absent(rows, path)
    assert read_log(spark, path, METRICS).count() == 2
    append_run(rows, path)
    assert read_log(spark, path, METRICS).count() == 3
    empty = str(tmp_path / "empty")
    create_if_absent(rows, empty)
    stored = spark.read.parquet(empty)
    assert stored.count() == 0 and stored.columns == rows.columns


def test_describe_and_database(spark, observations):
    create_database(spark, "default")
    rows = describe_table(observations({"day": 1, "temp_max": 1.0}, {"day": 2})).collect()
    by_name = {r.name: (r.type, r.nullable, r.non_null_rows) for r in rows}
    assert by_name["temp_max"] == ("double", True, 1)
    assert by_name["date"] == ("date", False, 2)
    assert by_name["load_ts"] == ("timestamp_ntz", True, 0)


def test_checks_find_faults(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("B", "x"), (None, "odd"), ("Z", None), ("Z", "odd")], "city string, label string"
    )
    assert check_not_null(df, "city").count() == 1
    assert [tuple(r) for r in check_accepted(df, "label", ["x"]).collect()] == [("odd", 2)]
    known = spark.createDataFrame([("A",), ("B",)], "name string")
    assert [tuple(r) for r in check_accepted(df, "city", known).collect()] == [("Z", 2)]
    tests = {"t": TableChecks(not_null=("city", "label"), accepted={"label": ("x",)})}
    rows = run_checks({"t": df}, tests).collect()
    assert {(r.column_name, r.check_name): r.failures for r in rows} == {
        ("city", "not_null"): 1,
        ("label", "not_null"): 1,
        ("label", "accepted_values"): 2,
    }


def test_landed_files_are_taken_once_and_the_newest_fetch_wins(spark, site):
    root, series = site
    table = f"{root}/raw"

    def run(load_ts):
        ingest_landed(spark, f"{root}/landing", series, table, f"{root}/checkpoint", load_ts)
        return {r.date.day: (r.temp_max, r.load_ts.day) for r in read_observations(spark, table).collect()}

    # Two fetches of overlapping days land before the first run.
    land(f"{root}/landing", "a", [payload("Northmere", "2026-03-01", 3)])
    land(f"{root}/landing", "b", [payload("Northmere", "2026-03-02", 3, shift=100.0)])
    os.utime(f"{root}/landing/a-Northmere.json", (1_000_000, 1_000_000))
    os.utime(f"{root}/landing/b-Northmere.json", (2_000_000, 2_000_000))
    first = run("2026-03-05 00:00:00")
    assert {d: v[0] for d, v in first.items()} == {1: 15.0, 2: 115.0, 3: 117.0, 4: 119.0}
    assert run("2026-03-06 00:00:00") == first

    land(f"{root}/landing", "c", [payload("Northmere", "2026-03-04", 2)])
    third = run("2026-03-07 00:00:00")
    assert third[4] == (15.0, 5) and third[5] == (17.0, 7)
