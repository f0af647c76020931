"""Parquet tables: atomic full rebuilds, month-wise upserts, logs of runs."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from daygrain import schemas
from daygrain.operators.checks import CheckFailed
from daygrain.operators.history import snapshot_scd2, touched_months
from daygrain.operators.upsert import inserted, upsert
from daygrain.sources import declared
from daygrain.sources import months as monthly
from daygrain.sources.files import COMPRESSED, children, delete

# Named tables and their schemas.
CATALOG = {
    "raw.city_weather": schemas.OBSERVATIONS,
    "dbt.moving_avg": schemas.MOVING_AVG,
    "dbt.temp_anomaly": schemas.TEMP_ANOMALY,
    "dbt.rolling_precip": schemas.ROLLING_PRECIP,
    "dbt.dry_spell": schemas.DRY_SPELL,
    "dbt.city_weather_snapshot": schemas.HISTORY,
    "adhoc.city_weather_train_view": schemas.TRAINING,
    "adhoc.city_weather_forecast": schemas.FORECAST,
    "analytics.city_weather_final": schemas.FINAL,
    "analytics.city_weather_model_metrics": schemas.METRICS,
    "analytics.city_weather_fit_outcomes": schemas.OUTCOMES,
    "adhoc.city_weather_moments": schemas.MOMENTS,
    "adhoc.city_weather_carry": schemas.CARRY,
}

#: How tables that are not rebuilt as a whole are stored; all others are versions.
BY_MONTH = ("raw.city_weather", "dbt.city_weather_snapshot", "adhoc.city_weather_moments", "adhoc.city_weather_carry")
BY_RUN = ("analytics.city_weather_model_metrics", "analytics.city_weather_fit_outcomes")

#: What the stages declare for the tables that rows are merged or logged into.
DECLARED = {
    "raw.city_weather": declared.Declaration(
        schemas.OBSERVATIONS, key=schemas.KEYS, defaults={"load_ts": "current_timestamp()"}
    ),
    "analytics.city_weather_model_metrics": declared.Declaration(
        schemas.METRICS, key=("run_ts", "series", "error_metric")
    ),
}

VERSION = "version-"
#: Key under which a manifest names the current version of a rebuilt table.
CURRENT = "current"


def table_path(root: str, name: str) -> str:
    if name not in CATALOG:
        raise KeyError(f"unknown table {name!r}; known: {sorted(CATALOG)}")
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


# --------------------------------------------------------------------------
# Full rebuilds: a version folder per build
# --------------------------------------------------------------------------


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version the newest manifest names, or None."""
    entries = monthly.manifest(spark, path)[1]
    return f"{path}/{entries[CURRENT]}" if CURRENT in entries else None


def write_version(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str] = (),
    by_month: bool = False,
    number: int | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> str:
    """Write a full rebuild into a new version folder, which nothing reads yet; returns its name.

    Rows are sorted within files only; after a window over the same columns that
    sort is free, and adaptive execution has sized the partitions.

    ``by_month`` spends one more shuffle to store the rows by month, for tables that
    are mostly read by date range. A month that dominates is split over tasks.

    ``watch`` is put around the rows in the stage that writes them, such as
    ``checks.Checking.watch``: what it counts, it counts once.
    """
    spark = df.sparkSession
    if number is None:
        number = monthly.manifest(spark, path)[0] + 1
    version = f"{VERSION}{number:08d}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/{version}"
    rows = declared.conformed(df, path)
    if by_month:
        by = rows.withColumn("month", F.trunc("date", "month")).hint("rebalance", "month")
        watch(by.sortWithinPartitions("month", *sort_by)).write.options(**COMPRESSED).partitionBy("month").parquet(target)
    else:
        watch(rows.sortWithinPartitions(*sort_by) if sort_by else rows).write.options(**COMPRESSED).parquet(target)
    declared.require_sound(spark, path, target, rows.schema)
    return version


def publish(
    df: DataFrame, path: str, sort_by: Sequence[str] = (), by_month: bool = False
) -> str:
    """Write a full rebuild as a new version and return its folder.

    A version becomes the current one when a manifest that names it is renamed into
    place, so readers see the old or the new table, never a part, and a failed build
    leaves the old one. See :func:`write_version` for the other arguments.
    """
    spark = df.sparkSession
    number = monthly.manifest(spark, path)[0] + 1
    version = write_version(df, path, sort_by, by_month, number)
    monthly.switch(spark, path, number, {CURRENT: version})
    return f"{path}/{version}"


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions, and those of builds that were cut off.

    Returns the deleted folders. For the table's writer, between its builds.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    kept = set(monthly.kept_entries(spark, path, keep).values())
    found = [name for name in children(spark, path) if name.startswith(VERSION)]
    gone = [f"{path}/{name}" for name in found if name not in kept]
    for folder in gone:
        delete(spark, folder)
    monthly.drop_manifests(spark, path, keep)
    return gone


def load(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Read the current version of a published table, or a date range of it."""
    _, entries = monthly.manifest(spark, path)
    if not entries:
        raise FileNotFoundError(f"no committed version under {path}")
    if CURRENT not in entries:  # rebuilt month by month
        return between(monthly.read(spark, path, schema, entries=entries), start, end).drop("month")
    return read_version(spark, f"{path}/{entries[CURRENT]}", schema, start, end)


def read_version(
    spark: SparkSession, version: str, schema: StructType, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Read a version folder, or a date range of it."""
    if any(name.startswith("month=") for name in children(spark, version)):
        stored = StructType(schema.fields + [monthly.MONTH])
        rows = spark.read.schema(stored).parquet(version)
        return between(rows, start, end).drop("month")
    return between(spark.read.schema(schema).parquet(version), start, end)


# --------------------------------------------------------------------------
# The fact table: stored by month, touched months replaced in one commit
# --------------------------------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table stored by month has had a commit."""
    return monthly.exists(spark, path)


def read_observations(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Read the fact table; a date range also prunes the month partitions."""
    return between(monthly.read(spark, path, schemas.OBSERVATIONS), start, end).drop("month")


def between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows of a date range; where rows are stored by month, only its months."""
    by_month = "month" in df.columns
    if start is not None:
        first = F.to_date(F.lit(start))
        df = df.filter(F.col("date") >= first)
        if by_month:
            df = df.filter(F.col("month") >= F.trunc(first, "month"))
    if end is not None:
        last = F.to_date(F.lit(end))
        df = df.filter(F.col("date") <= last)
        if by_month:
            df = df.filter(F.col("month") <= last)
    return df


def upsert_observations(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    load_ts: str,
    touch_on_update: bool = False,
) -> None:
    """Merge a staged batch into the fact table.

    Only the months the batch touches are read and written again, as new files that
    one manifest brings in (:mod:`daygrain.sources.months`): a job that fails, at any
    step, leaves the table as it was, and can be run again.
    A batch that repeats a key or holds a NULL in one is refused.
    """
    monthly.commit(spark, path, merge_batch(spark, path, batch, load_ts, touch_on_update))


def merge_batch(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    load_ts: str,
    touch_on_update: bool = False,
    entries: Mapping[str, str] | None = None,
) -> str:
    """Write the months of the fact table that a batch touches, merged with it, into a folder nothing reads yet.

    ``entries`` name the state of the table to merge into, its newest commit by default.
    Only months that the table has are joined; in others every row of the batch is new.
    """
    if entries is None:
        entries = monthly.manifest(spark, path)[1]
    keys = list(schemas.KEYS)
    # A batch is a few weeks of days. It is parsed once and spills to disk if it must.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        months = months_of(batch, keys)
        held = [m for m in months if monthly.folder_name(m) in entries]
        rows = inserted(batch, schemas.OBSERVATIONS, load_ts)
        if held:
            stored = monthly.in_months(F.col("date"), held)
            target = monthly.read(spark, path, schemas.OBSERVATIONS, held, entries).drop("month")
            merged = upsert(target, batch.filter(stored), keys, load_ts, touch_on_update)
            rows = merged if len(held) == len(months) else merged.unionByName(rows.filter(~stored))
        return monthly.write_batch(rows, path, keys)
    finally:
        batch.unpersist()


def months_of(batch: DataFrame, keys: list[str]) -> list:
    """Months of a batch, in the same pass that refuses repeated keys.

    The set is bounded by the calendar, not by the rows of the batch.
    """
    seen = (
        batch.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(F.greatest(*[F.col(k).isNull() for k in keys])).alias("unkeyed"),
            F.collect_set(F.trunc("date", "month")).alias("months"),
            F.max_by(F.concat_ws(", ", *keys), F.when(F.col("n") > 1, F.col("n"))).alias("twice"),
        )
        .first()
    )
    if seen.unkeyed:
        raise CheckFailed(f"NULL key in batch: {seen.unkeyed} groups of {', '.join(keys)}")
    if seen.twice is not None:
        raise CheckFailed(f"duplicate key in batch: {seen.twice}")
    return seen.months


# --------------------------------------------------------------------------
# History: partitioned by month, rewritten where it changes
# --------------------------------------------------------------------------


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return monthly.read(spark, path, schemas.HISTORY).drop("month")


def write_snapshot(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    run_ts: str,
    strategy: str = "timestamp",
    **options,
) -> list:
    """Record one snapshot run in a stored history; returns the months written.

    A first pass compares both tables month by month and finds those that differ, a
    set bounded by the calendar. Only these are joined row by row and rewritten, so a
    daily run over a long history writes its last months and whatever was corrected.
    A run without changes makes no commit.
    """
    batch, months = snapshot_batch(spark, path, current, run_ts, strategy, None, **options)
    if batch is not None:
        monthly.commit(spark, path, batch)
    return months


def snapshot_batch(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    run_ts: str,
    strategy: str,
    entries: Mapping[str, str] | None,
    months: Sequence | None = None,
    **options,
) -> tuple[str | None, list]:
    """Write the months of a history that a run changes into a folder nothing reads yet.

    Returns the folder, or None if nothing changed, and the changed months. The first run
    writes all rows and names no months. Where the caller knows that no others have changed,
    ``months`` are those to compare, and ``current`` holds their rows. Only months that the
    history has are joined; in others every row is new.
    """
    if entries is None:
        entries = monthly.manifest(spark, path)[1]
    if not entries:
        first = snapshot_scd2(None, current, run_ts, strategy, **options)
        return monthly.write_batch(first, path, schemas.KEYS), []
    history = monthly.read(spark, path, schemas.HISTORY, months, entries)
    changes = touched_months(history, current, run_ts, strategy=strategy, **options)
    months = sorted((r.month for r in changes.collect()), key=lambda m: (m is not None, m))
    if not months:
        return None, []
    held = [m for m in months if monthly.folder_name(m) in entries]
    now = current.filter(monthly.in_months(F.col("date"), months))
    rows = snapshot_scd2(None, now, run_ts, strategy, **options)
    if held:
        stored = monthly.in_months(F.col("date"), held)
        past = monthly.read(spark, path, schemas.HISTORY, held, entries).drop("month")
        joined = snapshot_scd2(past, now.filter(stored), run_ts, strategy, **options)
        rows = joined if len(held) == len(months) else joined.unionByName(rows.filter(~stored))
    return monthly.write_batch(rows, path, schemas.KEYS), months


# --------------------------------------------------------------------------
# Logs, views, schemas
# --------------------------------------------------------------------------


def create_if_absent(df: DataFrame, path: str) -> None:
    """Create an empty table with a query's schema; an existing one stays."""
    df.limit(0).write.mode("ignore").parquet(path)


def stamped(df: DataFrame, run_ts: str) -> DataFrame:
    """Rows of a log with the time of their run in front."""
    stamp = F.lit(run_ts).cast(TimestampNTZType())
    return df.select(stamp.alias("run_ts"), *df.columns)


def run_name(run_ts: str) -> str:
    """A run's folder: its time in digits."""
    moment = datetime.datetime.fromisoformat(run_ts)
    return moment.strftime("%Y%m%d%H%M%S%f")


def append_run(df: DataFrame, path: str, run_ts: str | None = None) -> None:
    """Log the rows of a run, stamped with its time (now, unless given), as one commit.

    A run that is logged again replaces its rows; one that is cut off leaves the log as it was.
    """
    run_ts = run_ts or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None).isoformat(" ")
    monthly.commit(df.sparkSession, path, monthly.write_run(stamped(df, run_ts), path, run_name(run_ts)))


def read_log(
    spark: SparkSession, path: str, schema: StructType, entries: Mapping[str, str] | None = None
) -> DataFrame:
    """All runs of a log; none before the first."""
    return monthly.read(spark, path, schema, entries=entries, by=monthly.RUN).drop("run")


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def describe_table(df: DataFrame, counts: bool = True) -> DataFrame:
    """Column name, type and nullability; with ``counts`` the number of non-NULL values as well.

    The counts of all columns come from one pass over the table; without them nothing is read.
    """
    fields = df.schema.fields
    if not counts:
        rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in fields]
        return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")
    counted = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in fields])
    entries = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f.name).alias("non_null_rows"),
        )
        for f in fields
    ]
    return counted.select(F.inline(F.array(*entries)))
