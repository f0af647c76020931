"""JSON payloads of parallel daily arrays, and the series dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.operators.checks import CheckFailed
from daygrain.operators.joins import broadcast_if_small
from daygrain.schemas import PAYLOAD, SERIES, STAGE

# Payload array -> column of the fact table.
PAYLOAD_FIELDS = {
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "temperature_2m_mean": "temp_mean",
    "precipitation_sum": "precipitation_mm",
    "windspeed_10m_max": "wind_speed_max_kmh",
    "weathercode": "weather_code",
}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Read a landing folder of payload files; a malformed one fails the job."""
    return spark.read.schema(PAYLOAD).option("mode", "FAILFAST").json(path)


def stream_payloads(spark: SparkSession, path: str) -> DataFrame:
    """New files of a landing folder, each with the fetch it came from."""
    reader = spark.readStream.schema(PAYLOAD).option("mode", "FAILFAST")
    fetch = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return reader.json(path).select("*", fetch.alias("fetch"))


def parse_payloads(df: DataFrame, column: str = "payload") -> DataFrame:
    """Parse payloads that arrive as a string column."""
    parsed = F.from_json(column, PAYLOAD, {"mode": "FAILFAST"})
    return df.select(parsed.alias("p")).select("p.*")


def read_series(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """Read the series dimension: a JSON list of ``{city, lat, lon}``.

    A list is one value and so one task per file; for a long dimension write one
    object per line and set ``json_lines``.
    """
    reader = spark.read.schema(SERIES).option("mode", "FAILFAST")
    return reader.option("multiLine", not json_lines).json(path)


def flatten_daily(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """One row per day of each payload.

    The arrays are matched by position with ``time``. An array that is shorter
    than ``time`` raises (or gives NULLs when ``strict`` is off); the surplus of
    a longer one is ignored. The expansion is a narrow operation: no shuffle.
    """
    daily = F.col("daily")
    days = F.coalesce(F.size(daily["time"]), F.lit(0))
    fitting = [F.slice(daily[name], F.lit(1), days).alias(name) for name in PAYLOAD_FIELDS]
    zipped = F.arrays_zip(daily["time"].alias("time"), *fitting)
    if strict:
        short = F.lit(False)
        for name in PAYLOAD_FIELDS:
            short = short | (F.coalesce(F.size(daily[name]), F.lit(0)) < days)
        message = F.concat(
            F.lit("payload array shorter than time for "), F.coalesce("city", F.lit("?"))
        )
        zipped = F.when(short, F.raise_error(message)).otherwise(zipped)
    carried = [c for c in payloads.columns if c != "daily"]
    rows = payloads.select(*carried, F.inline(zipped))
    return rows.select(
        *carried,
        F.to_date("time").alias("date"),
        *[F.col(source).alias(target) for source, target in PAYLOAD_FIELDS.items()],
    )


def attach_series(rows: DataFrame, series: DataFrame) -> DataFrame:
    """Add latitude and longitude; an unlisted series is left out, as it has no coordinates."""
    dimension = series.select(
        "city", F.col("lat").alias("latitude"), F.col("lon").alias("longitude")
    )
    return rows.join(broadcast_if_small(dimension), "city")


def conform(df: DataFrame, schema: StructType = STAGE) -> DataFrame:
    """Select and cast to a declared schema, by name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_batch(payloads: DataFrame, series: DataFrame, strict: bool = True) -> DataFrame:
    """Payloads of all series to typed records, as one distributed plan."""
    return conform(attach_series(flatten_daily(payloads, strict), series))


def require_payloads(payloads: DataFrame, series: DataFrame) -> None:
    """Raise unless every listed series has a payload with at least one day.

    One anti join of the series list; the message names up to ten that are missing.
    """
    present = payloads.filter(F.size("daily.time") > 0).select("city").distinct()
    missing = series.select("city").distinct().join(present, "city", "left_anti").limit(11).collect()
    if missing:
        names = ", ".join(sorted(str(r.city) for r in missing[:10]))
        raise CheckFailed(f"no payload for listed series: {names}{' and others' if len(missing) > 10 else ''}")


def newest_fetch(rows: DataFrame) -> DataFrame:
    """Where several fetches hold the same day, keep the values of the newest.

    This is what loading the fetches one after the other would leave.
    """
    values = list(PAYLOAD_FIELDS.values())
    newest = rows.groupBy("city", "date").agg(
        F.max_by(F.struct(*values), "fetch").alias("values")
    )
    return newest.select("city", "date", "values.*")


def pack_daily(df: DataFrame) -> DataFrame:
    """The inverse of :func:`flatten_daily`: one payload per series and month.

    A payload holds at most 31 days, so no group grows with the history.
    """
    record = F.struct(
        F.col("date"), *[F.col(column).alias(name) for name, column in PAYLOAD_FIELDS.items()]
    )
    grouped = df.groupBy("city", F.trunc("date", "month").alias("month")).agg(
        F.sort_array(F.collect_list(record)).alias("days")
    )
    # A field of an array of structs is the array of that field.
    arrays = [F.col(f"days.{name}").alias(name) for name in PAYLOAD_FIELDS]
    time = F.col("days.date").cast("array<string>").alias("time")
    return grouped.select("city", F.struct(time, *arrays).alias("daily"))


def write_payloads(df: DataFrame, path: str) -> None:
    """Write packed payloads as compressed JSON lines, keeping NULL elements in place."""
    df.write.option("ignoreNullFields", "false").option("compression", "gzip").json(path)


def series_of(df: DataFrame) -> DataFrame:
    """The series dimension of a fact table: one coordinate pair per series."""
    return df.groupBy("city").agg(
        F.max("latitude").alias("lat"), F.max("longitude").alias("lon")
    )
