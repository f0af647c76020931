"""Properties on random tables: blocks change nothing, merges are idempotent."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from compare import rows_of
from daygrain.operators.analytics import (
    rain_streaks,
    sigma_flags,
    temp_ranks,
    trend_deviation,
)
from daygrain.operators.bands import value_bands, with_band
from daygrain.operators.checks import CheckFailed, check_unique
from daygrain.operators.dashboard import temp_distribution
from daygrain.operators.history import open_rows, snapshot_scd2, touched_months
from daygrain.operators.models import dry_spell, moving_avg, rolling_precip, temp_anomaly
from daygrain.operators.upsert import upsert
from daygrain.schemas import KEYS, OBSERVATIONS, STAGE
from daygrain.sources.payloads import conform, flatten_daily, pack_daily


def contents(df):
    return rows_of(df.columns, df.collect())


@pytest.fixture(scope="module")
def uneven(spark):
    """One series with most of the rows, others sparse, gaps and missing values."""
    rng = random.Random(7)
    rows = []
    for city, days, keep in (("hot", 400, 0.9), ("thin", 400, 0.05), ("short", 9, 1.0), ("one", 1, 1.0)):
        for i in range(days):
            if rng.random() >= keep:
                continue
            temp = None if rng.random() < 0.1 else float(rng.randint(-5, 5))
            amount = None if rng.random() < 0.1 else rng.choice([0.0, 0.0, 0.0, 1.25, 30.0])
            day = datetime.date(2023, 11, 1) + datetime.timedelta(days=i)
            rows.append(
                (city, 1.0, 2.0, day, temp, temp, temp, amount, 3.0, rng.randint(0, 99), None)
            )
    return spark.createDataFrame(rows, OBSERVATIONS).cache()


@pytest.fixture(scope="module")
def rough(spark, uneven):
    """The same with keys that are missing, and values that are no ordinary numbers."""
    rows = []
    for city, day, temp in (
        ("hot", None, 3.0),
        ("lone", None, 1.0),
        (None, datetime.date(2024, 1, 5), 2.0),
        (None, datetime.date(2024, 3, 6), 4.0),
        (None, None, 5.0),
        ("odd", datetime.date(2024, 1, 1), float("nan")),
        ("odd", datetime.date(2024, 1, 9), float("inf")),
        ("odd", datetime.date(2024, 1, 20), float("-inf")),
        ("big", datetime.date(2024, 1, 1), 1e13),
        ("big", datetime.date(2024, 1, 9), -1e13),
        ("big", datetime.date(2024, 2, 9), 2e12),
    ):
        rows.append((city, 1.0, 2.0, day, temp, temp, temp, temp, 3.0, 1, None))
    nullable = StructType([StructField(f.name, f.dataType, True) for f in OBSERVATIONS.fields])
    return uneven.union(spark.createDataFrame(rows, nullable)).cache()


WINDOWED = {
    "moving_avg": moving_avg,
    "temp_anomaly": temp_anomaly,
    "rolling_precip": rolling_precip,
    "dry_spell": dry_spell,
    "dry_spell_documented": lambda df, **k: dry_spell(df, anchor="documented", **k),
    "trend_deviation": trend_deviation,
    "sigma_flags": sigma_flags,
    "temp_ranks": temp_ranks,
    "rain_streaks": rain_streaks,
    "temp_distribution": temp_distribution,
}


@pytest.mark.parametrize("name", WINDOWED)
def test_blocks_change_nothing(rough, name):
    operator = WINDOWED[name]
    plain = contents(operator(rough))
    for days in (1, 7, 100):
        assert contents(operator(rough, block_days=days)) == plain, days


@pytest.mark.parametrize("operator", [temp_anomaly, sigma_flags])
def test_broadcast_changes_nothing(rough, operator):
    for limit in (0, 3, 4, 100):
        assert contents(operator(rough, max_broadcast_rows=limit)) == contents(operator(rough))


@pytest.mark.parametrize("name", ["trend_deviation", "sigma_flags", "temp_ranks"])
def test_missing_keys_lose_no_rows(rough, name):
    for days in (None, 7):
        assert WINDOWED[name](rough, block_days=days).count() == rough.count()


def test_bands_are_even_beside_an_outlier(spark):
    values = spark.range(5000).selectExpr("'A' AS city", "cast(id AS double) AS v")
    values = values.union(spark.sql("SELECT 'A', 1e12D"))
    sizes = [r["count"] for r in with_band(values, value_bands(values, "city", "v"), "city", "v").groupBy("_band").count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 2 * 5001 / 64


def test_windows_are_bounded(uneven):
    df = moving_avg(uneven)
    assert df.agg(F.max("rolling_window_days")).first()[0] == 7
    assert df.count() == uneven.filter("temp_max IS NOT NULL").count()


def test_streak_lengths_add_up_to_rain_days(uneven):
    total = rain_streaks(uneven).agg(F.sum("streak_length_days")).first()[0]
    assert total == uneven.filter("precipitation_mm > 0").count()


def test_flatten_undoes_pack(uneven):
    flat = flatten_daily(pack_daily(uneven))
    assert contents(flat) == contents(uneven.select(*flat.columns))


def test_upsert_twice_equals_once(uneven):
    target = uneven.filter("date < '2024-02-01'")
    batch = conform(uneven.filter("date >= '2024-01-10'").withColumn("temp_min", F.lit(9.0)), STAGE)
    once = upsert(target, batch, KEYS, "2024-03-01 00:00:00")
    twice = upsert(once, batch, KEYS, "2024-04-01 00:00:00")
    assert contents(once) == contents(twice)
    assert check_unique(once, KEYS).count() == 0
    assert once.count() == uneven.count()
    assert once.columns == target.columns and once.schema["load_ts"].dataType == OBSERVATIONS["load_ts"].dataType


def test_upsert_keeps_the_load_time_of_matched_rows(observations):
    loaded = datetime.datetime(2026, 3, 1)
    now = "2026-03-09 00:00:00"
    target = observations(
        {"day": 1, "temp_max": 1.0, "load_ts": loaded}, {"day": 2, "temp_max": 2.0, "load_ts": loaded}
    )
    batch = conform(observations({"day": 2, "temp_max": None}, {"day": 3, "temp_max": 3.0}), STAGE)
    rows = upsert(target, batch, KEYS, now).orderBy("date").collect()
    later = datetime.datetime(2026, 3, 9)
    assert [r.temp_max for r in rows] == [1.0, None, 3.0]
    assert [r.load_ts for r in rows] == [loaded, loaded, later]
    rows = upsert(target, batch, KEYS, now, touch_on_update=True).orderBy("date").collect()
    assert [r.load_ts for r in rows] == [loaded, later, later]


# --------------------------------------------------------------------------
# History
# --------------------------------------------------------------------------


def ts(day, hour=0):
    return datetime.datetime(2026, 3, day, hour)


def spans(history):
    rows = history.orderBy("date", "valid_from").collect()
    return [(r.date.day, r.temp_max, r.valid_from, r.valid_to) for r in rows]


def test_timestamp_history_sees_new_and_removed_keys_only(observations):
    first = snapshot_scd2(None, observations({"day": 1, "temp_max": 1.0}, {"day": 2, "temp_max": 2.0}), "2026-03-10 00:00:00")
    second = snapshot_scd2(
        first, observations({"day": 2, "temp_max": 99.0}, {"day": 3, "temp_max": 3.0}), "2026-03-11 00:00:00"
    )
    assert spans(second) == [
        (1, 1.0, ts(1), ts(11)),
        (2, 2.0, ts(2), None),
        (3, 3.0, ts(3), None),
    ]
    assert [r.row_key for r in second.orderBy("date").collect()][0] == "A_2026-03-01"


def test_check_history_records_corrections(observations):
    states = [
        observations({"day": 1, "temp_max": 1.0}, {"day": 2, "temp_max": None}),
        observations({"day": 1, "temp_max": 1.5}, {"day": 2, "temp_max": 2.0}),
        observations({"day": 2, "temp_max": 2.0}),
        observations({"day": 1, "temp_max": 1.5}, {"day": 2, "temp_max": 2.0}),
    ]
    history = None
    for run, state in enumerate(states, start=10):
        history = snapshot_scd2(history, state, f"2026-03-{run} 00:00:00", strategy="check")
    assert spans(history) == [
        (1, 1.0, ts(10), ts(11)),
        (1, 1.5, ts(11), ts(12)),
        (1, 1.5, ts(13), None),
        (2, None, ts(10), ts(11)),
        (2, 2.0, ts(11), None),
    ]


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_unchanged_run_adds_nothing_and_open_rows_are_current(uneven, strategy):
    first = snapshot_scd2(None, uneven, "2026-03-10 00:00:00", strategy)
    again = snapshot_scd2(first, uneven, "2026-03-11 00:00:00", strategy)
    assert contents(first) == contents(again)
    assert contents(open_rows(again).select(*STAGE.names)) == contents(uneven.select(*STAGE.names))


def test_timestamp_history_with_a_moving_column(observations):
    """With a real modification time the strategy does record a correction."""
    columns = ["city", "date", "temp_max", "load_ts"]
    options = dict(strategy="timestamp", updated_at="load_ts", columns=columns)
    first = snapshot_scd2(
        None, observations({"day": 1, "temp_max": 1.0, "load_ts": ts(5)}), "2026-03-10 00:00:00", **options
    )
    second = snapshot_scd2(
        first, observations({"day": 1, "temp_max": 2.0, "load_ts": ts(6)}), "2026-03-11 00:00:00", **options
    )
    assert spans(second) == [(1, 1.0, ts(5), ts(6)), (1, 2.0, ts(6), None)]


def test_months_differ_when_a_value_moves_between_columns(observations):
    """NULLs do not enter a hash by themselves, so their place has to."""
    before = observations({"day": 1, "temp_max": 5.0}, {"day": 40})
    after = observations({"day": 1, "temp_min": 5.0}, {"day": 40})
    history = snapshot_scd2(None, before, "2026-06-01 00:00:00", "check")

    def months(current, strategy="check", base=history):
        run = touched_months(base, current, "2026-06-02 00:00:00", strategy=strategy)
        return sorted(r.month.month for r in run.collect())

    assert months(after) == [3]
    assert months(before) == []
    assert months(before.filter("date < '2026-04-01'")) == [4]
    assert months(observations()) == [3, 4]
    by_time = snapshot_scd2(None, before, "2026-06-01 00:00:00")
    assert months(after, "timestamp", by_time) == []
    more = before.unionByName(observations({"day": 41}))
    assert months(more, "timestamp", by_time) == [4]


def test_hard_deletes_can_be_left_open(observations):
    first = snapshot_scd2(None, observations({"day": 1, "temp_max": 1.0}), "2026-03-10 00:00:00")
    second = snapshot_scd2(
        first, observations(), "2026-03-11 00:00:00", invalidate_hard_deletes=False
    )
    assert spans(second) == [(1, 1.0, ts(1), None)]


def test_unknown_strategy(observations):
    with pytest.raises(ValueError, match="strategy"):
        snapshot_scd2(None, observations(), "2026-03-10 00:00:00", strategy="other")


def test_strict_flatten_refuses_short_arrays(spark):
    from daygrain.schemas import PAYLOAD
    from daygrain.sources.payloads import parse_payloads

    def payload(arrays):
        import json

        daily = {"time": ["2026-03-01", "2026-03-02"], **arrays}
        return json.dumps({"city": "A", "daily": daily})

    fields = [f.name for f in PAYLOAD["daily"].dataType.fields if f.name != "time"]
    full = {name: [1, 2] for name in fields}
    text = spark.createDataFrame([(payload({**full, "weathercode": [1]}),)], "payload string")
    with pytest.raises(Exception, match="shorter than time for A"):
        flatten_daily(parse_payloads(text)).collect()
    rows = flatten_daily(parse_payloads(text), strict=False).orderBy("date").collect()
    assert [r.weather_code for r in rows] == [1, None]

    text = spark.createDataFrame([(payload({**full, "weathercode": [1, 2, 3]}),)], "payload string")
    assert [r.weather_code for r in flatten_daily(parse_payloads(text)).orderBy("date").collect()] == [1, 2]

    text = spark.createDataFrame([("{broken",)], "payload string")
    with pytest.raises(Exception, match="(?i)malformed"):
        flatten_daily(parse_payloads(text)).collect()


def test_duplicate_batch_is_refused(spark, observations, tmp_path):
    from daygrain.sources.tables import upsert_observations

    batch = conform(observations({"day": 1}, {"day": 1}), STAGE)
    with pytest.raises(CheckFailed, match="A, 2026-03-01"):
        upsert_observations(spark, str(tmp_path / "t"), batch, "2026-03-02 00:00:00")
