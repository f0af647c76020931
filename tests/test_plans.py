"""Plans: how often rows move, and what reaches the scan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from daygrain.operators.analytics import (
    compare_series,
    last_days,
    longest_rain_streaks,
    sigma_flags,
    temp_ranks,
    trend_deviation,
)
from daygrain.operators import bands
from daygrain.operators.carry import carry_over
from daygrain.operators.dashboard import climate_profile, latest_month_avg, monthly_averages, temp_distribution
from daygrain.operators.forecast import evaluate, fit_trend, predict, training_set, uncertainty
from daygrain.operators.history import snapshot_scd2, touched_months
from daygrain.operators.joins import broadcast_if_small, fits_broadcast
from daygrain.operators.models import dry_spell, moving_avg, rolling_precip, temp_anomaly
from daygrain.operators.series import choose_block_days
from daygrain.operators.upsert import upsert
from daygrain.schemas import KEYS, OBSERVATIONS, STAGE
from daygrain import session
from daygrain.plans import queries
from daygrain.plans.queries import QUERIES
from daygrain.sources import bindings, bucketed, files, tables
from daygrain.sources import months as monthly
from daygrain.sources.bindings import daily_obs
from daygrain.sources.payloads import conform
from daygrain.sources.tables import read_observations, upsert_observations


@pytest.fixture(scope="module")
def table(spark, data_dir, tmp_path_factory):
    """A stored fact table, so that plans start at a Parquet scan."""
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    batch = conform(daily_obs(spark, data_dir), STAGE)
    upsert_observations(spark, path, batch, "2024-02-01 00:00:00")
    return path


@pytest.fixture(scope="module")
def raw(spark, table):
    return read_observations(spark, table)


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def shuffles(df):
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|Round)", plan(df)))


def sorts(df):
    return len(re.findall(r"(?<!\w)Sort \[", plan(df)))


@pytest.mark.parametrize(
    "operator", [moving_avg, rolling_precip, dry_spell, trend_deviation], ids=lambda f: f.__name__
)
def test_one_shuffle_and_one_sort_per_rolling_model(raw, operator):
    df = operator(raw)
    assert (shuffles(df), sorts(df)) == (1, 1)
    assert "Exchange hashpartitioning(city," in plan(df)


def test_sorting_for_the_write_is_free_after_a_window(raw):
    df = moving_avg(raw).sortWithinPartitions("city", "date")
    assert sorts(df) == 1


def test_streaks_are_aggregated_where_the_window_left_them(raw):
    df = longest_rain_streaks(raw)
    assert shuffles(df) == 1
    assert "TakeOrderedAndProject" in plan(df)


def test_ranks_shuffle_once(raw):
    assert shuffles(temp_ranks(raw)) == 1


@pytest.mark.parametrize("operator", [temp_anomaly, sigma_flags], ids=lambda f: f.__name__)
def test_few_series_do_not_move_the_rows(raw, operator):
    text = plan(operator(raw, max_broadcast_rows=1000))
    assert "BroadcastHashJoin" in text
    # The only shuffle is that of the pre-aggregated averages.
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


@pytest.mark.parametrize("operator", [temp_anomaly, sigma_flags], ids=lambda f: f.__name__)
def test_many_series_take_one_shuffle_and_no_broadcast(raw, operator):
    for df in (operator(raw), operator(raw, max_broadcast_rows=0)):
        assert shuffles(df) == 1 and "Broadcast" not in plan(df)


def test_long_keys_are_not_broadcast_however_few(spark):
    few = spark.range(100).selectExpr("repeat('k', 1000) || id AS city", "1.0D AS latitude")
    assert fits_broadcast(few)
    assert not fits_broadcast(few, max_bytes=100_000)
    assert not fits_broadcast(few, max_rows=99)
    assert fits_broadcast(few.limit(0), max_rows=0, max_bytes=0)
    assert "Broadcast" in plan(few.join(broadcast_if_small(few), "city"))


def test_blocks_split_the_series(raw):
    assert "hashpartitioning(city, _block" in plan(moving_avg(raw, block_days=7))
    assert "hashpartitioning(city, _block" in plan(dry_spell(raw, block_days=7))


def test_scan_reads_needed_columns_and_takes_the_filters(raw):
    text = plan(dry_spell(raw))
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert "temp_min" not in schema and "latitude" not in schema
    assert "IsNotNull(precipitation_mm)" in text
    assert "IsNotNull(temp_max), IsNotNull(temp_min), IsNotNull(temp_mean)" in plan(moving_avg(raw))
    assert "EqualTo(city,S_1)" in plan(last_days(raw, "S_1"))


def test_series_filter_passes_the_windows(raw):
    df = dry_spell(raw).filter("city = 'S_1'")
    assert "EqualTo(city,S_1)" in plan(df)
    text = plan(dry_spell(raw).filter("date > '2024-01-10'"))
    assert "GreaterThan(date" not in text


def test_date_range_prunes_months(spark, table):
    text = plan(read_observations(spark, table, "2024-01-05", "2024-01-20"))
    (pruned,) = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert "month" in pruned


def test_comparison_scans_once_without_a_join(raw):
    text = plan(compare_series(raw, ["S_0", "S_1", "S_2", "S_3"]))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "In(city" in text and "partial_max" in text


def test_fit_is_a_partial_aggregation(raw):
    model = fit_trend(training_set(raw))
    assert shuffles(model) == 1
    assert "partial_count(temp_max)" in plan(model)
    assert shuffles(predict(model)) == 1
    assert "Window" not in plan(predict(model))


def test_forecast_ranking_keeps_the_partitioning(raw):
    assert shuffles(uncertainty(predict(fit_trend(training_set(raw))))) <= 2


def test_holdout_is_cut_before_the_shuffle(raw):
    text = plan(evaluate(raw))
    assert "Partial" in text and "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_bucketed_table_needs_no_shuffle_by_series(spark, data_dir, tmp_path):
    name = "plans_bucketed"
    bucketed.register(spark, name, str(tmp_path / "t"), buckets=8)
    try:
        batch = conform(daily_obs(spark, data_dir), STAGE)
        bucketed.upsert_bucketed(spark, name, batch, "2024-02-01 00:00:00")
        table = bucketed.read(spark, name)
        for operator in (moving_avg, rolling_precip, dry_spell, temp_anomaly, temp_ranks, fit_trend):
            assert shuffles(operator(table)) == 0, operator.__name__
        setting = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
        with bucketed._settings(spark, setting):
            merged = upsert(table, batch.repartition(8, "city"), KEYS, "2024-02-02 00:00:00")
            text = plan(merged)
        # Only the batch is spread; the stored months are merged where they lie.
        stored = text[text.index("FullOuter") : text.index("Bucketed: true")]
        assert "Exchange" not in stored
    finally:
        bucketed.drop(spark, name)


def test_merge_and_history_join_on_the_whole_key(raw):
    merged = plan(upsert(raw, conform(raw, STAGE), KEYS, "2024-02-01 00:00:00"))
    assert "SortMergeJoin [city, date], [city, date], FullOuter" in merged
    first = snapshot_scd2(None, raw, "2024-02-01 00:00:00")
    second = plan(snapshot_scd2(first, raw, "2024-02-02 00:00:00"))
    assert "FullOuter" in second and "CartesianProduct" not in second


def test_history_comparison_shuffles_no_rows(raw):
    first = snapshot_scd2(None, raw, "2024-02-01 00:00:00", "check")
    text = plan(touched_months(first, raw, "2024-02-02 00:00:00", strategy="check"))
    # Each side is grouped by one expression, the month, after a partial aggregation.
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert keys == ["_groupingexpression, 8"] * 2
    assert text.count("partial_bit_xor") == 4


def test_aggregates_of_a_model_skip_its_windows(raw):
    assert "Window" not in plan(climate_profile(moving_avg(raw)))
    assert "Window" not in plan(monthly_averages(rolling_precip(raw)))


def test_latest_month_is_one_scalar(raw):
    text = plan(latest_month_avg(moving_avg(raw)))
    assert "Subquery" in text and "Join" not in text


def test_binding_hashes_instead_of_sorting(spark, data_dir):
    assert "SortAggregate" not in plan(daily_obs(spark, data_dir))


def test_block_choice_follows_the_calendar(raw, observations):
    assert choose_block_days(raw) is None
    assert choose_block_days(raw, max_days=10) == 10
    assert choose_block_days(observations()) is None
    assert OBSERVATIONS.names[0] == "city"


@pytest.mark.parametrize(
    "operator,block_days,scans",
    [(temp_distribution, None, 1), (temp_distribution, 5, 1), (temp_ranks, 5, 2), (temp_ranks, None, 1)],
)
def test_ranks_and_quartiles_read_the_table_once_or_twice(raw, monkeypatch, operator, block_days, scans):
    """Reads of the table itself, in the result and in the small tables that are written for it."""
    plans = []
    original = bands.written

    def written(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(df, label)

    monkeypatch.setattr(bands, "written", written)
    plans.append(operator(raw, block_days=block_days)._jdf.queryExecution().optimizedPlan().toString())
    # Only the fact table has a month; small written tables have none.
    assert sum(len(re.findall(r"Relation \[[^\]]*\bmonth#", text)) for text in plans) == scans


def test_shipments_move_to_as_many_tasks_as_their_rows_need(spark, data_dir, monkeypatch):
    """What a task groups follows from ROWS_A_TASK, not from the number of shuffle partitions."""
    query = QUERIES["month_moments"]
    whole = sorted(map(str, query(spark, data_dir).collect()))
    monkeypatch.setattr(bindings, "ROWS_A_TASK", 400)
    dealt = query(spark, data_dir)
    tasks = bindings.ship_tasks(spark, data_dir)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    moves = re.findall(r"Exchange hashpartitioning\([^)]*?, (\d+)\)", plan(dealt))
    assert moves == [str(tasks)] * 2
    assert sorted(map(str, dealt.collect())) == whole


def test_a_carry_moves_rows_once(spark, table, tmp_path):
    rows = monthly.read(spark, table, OBSERVATIONS)
    spells = dry_spell(rows).withColumn("month", F.trunc("date", "month"))
    spells.write.parquet(f"{tmp_path}/spells")
    months = monthly.months_in(monthly.manifest(spark, table)[1])
    assert shuffles(carry_over(rows, spark.read.parquet(f"{tmp_path}/spells"), months)) == 1


def test_only_stored_months_are_joined(spark, observations, tmp_path, monkeypatch):
    """Rows of months that the table lacks are all new, so no join is made for them."""
    path, joined = f"{tmp_path}/facts", []
    join = tables.upsert

    def watched(target, batch, *args):
        joined.append(sorted(r.day for r in batch.selectExpr("dayofmonth(date) AS day").collect()))
        return join(target, batch, *args)

    monkeypatch.setattr(tables, "upsert", watched)
    upsert_observations(spark, path, conform(observations({"day": 1, "temp_max": 1.0}, {"day": 2}), STAGE), "2026-04-01 00:00:00")
    assert joined == []
    later = observations({"day": 1, "temp_max": 5.0}, {"day": 3}, {"day": 35, "temp_max": 7.0})
    upsert_observations(spark, path, conform(later, STAGE), "2026-05-01 00:00:00")
    assert joined == [[1, 3]]
    rows = read_observations(spark, path).orderBy("date").collect()
    assert [(r.date.month, r.date.day, r.temp_max, r.load_ts.month) for r in rows] == [
        (3, 1, 5.0, 4),
        (3, 2, None, 4),
        (3, 3, None, 5),
        (4, 4, 7.0, 5),
    ]


def test_month_query_leaves_only_its_tables(spark, data_dir, monkeypatch):
    """Payloads and derived rows that have been read are gone; the result does not need them."""
    roots = []
    original = session.scratch_path

    def watched(spark, label):
        roots.append(original(spark, label))
        return roots[-1]

    monkeypatch.setattr(queries, "scratch_path", watched)
    monkeypatch.setattr(session, "scratch_path", watched)
    rows = QUERIES["moving_avg_month_by_month"](spark, data_dir).count()
    left = {child for root in roots for child in files.children(spark, root)}
    assert rows > 0 and len(roots) == 2
    assert left == {"_release", "adhoc", "dbt", "raw", "series"}
