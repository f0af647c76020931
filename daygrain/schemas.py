"""Declared schemas. Every read names one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, nullable) for name, dtype, nullable in fields])


KEYS = ("city", "date")
VALUE_COLS = (
    "latitude",
    "longitude",
    "temp_max",
    "temp_min",
    "temp_mean",
    "precipitation_mm",
    "wind_speed_max_kmh",
    "weather_code",
)

#: One incoming record: the fact table without its load time.
STAGE = _struct(
    ("city", StringType(), False),
    ("latitude", DoubleType(), True),
    ("longitude", DoubleType(), True),
    ("date", DateType(), False),
    ("temp_max", DoubleType(), True),
    ("temp_min", DoubleType(), True),
    ("temp_mean", DoubleType(), True),
    ("precipitation_mm", DoubleType(), True),
    ("wind_speed_max_kmh", DoubleType(), True),
    ("weather_code", IntegerType(), True),
)

#: The fact table: one row per series and day.
OBSERVATIONS = StructType(STAGE.fields + [StructField("load_ts", TimestampNTZType(), True)])

SERIES = _struct(
    ("city", StringType(), False),
    ("lat", DoubleType(), True),
    ("lon", DoubleType(), True),
)

#: Raw payload: parallel arrays, one element per day.
PAYLOAD = _struct(
    ("city", StringType(), True),
    (
        "daily",
        _struct(
            ("time", ArrayType(StringType()), True),
            ("temperature_2m_max", ArrayType(DoubleType()), True),
            ("temperature_2m_min", ArrayType(DoubleType()), True),
            ("temperature_2m_mean", ArrayType(DoubleType()), True),
            ("precipitation_sum", ArrayType(DoubleType()), True),
            ("windspeed_10m_max", ArrayType(DoubleType()), True),
            ("weathercode", ArrayType(IntegerType()), True),
        ),
        True,
    ),
)

MOVING_AVG = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("temp_max", DoubleType(), True),
    ("temp_min", DoubleType(), True),
    ("temp_mean", DoubleType(), True),
    ("precipitation_mm", DoubleType(), True),
    ("wind_speed_max_kmh", DoubleType(), True),
    ("temp_max_7day_avg", DoubleType(), True),
    ("temp_min_7day_avg", DoubleType(), True),
    ("temp_mean_7day_avg", DoubleType(), True),
    ("rolling_window_days", LongType(), True),
)

TEMP_ANOMALY = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("temp_max", DoubleType(), True),
    ("temp_min", DoubleType(), True),
    ("temp_mean", DoubleType(), True),
    ("avg_temp_max", DoubleType(), True),
    ("avg_temp_min", DoubleType(), True),
    ("avg_temp_mean", DoubleType(), True),
    ("temp_max_anomaly", DoubleType(), True),
    ("temp_min_anomaly", DoubleType(), True),
    ("temp_mean_anomaly", DoubleType(), True),
    ("anomaly_category", StringType(), True),
)

ROLLING_PRECIP = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("precipitation_mm", DoubleType(), True),
    ("temp_max", DoubleType(), True),
    ("temp_min", DoubleType(), True),
    ("weather_code", IntegerType(), True),
    ("is_rain_day", LongType(), True),
    ("precip_7day_rolling_sum", DoubleType(), True),
    ("rain_days_last_7", LongType(), True),
    ("precip_30day_rolling_sum", DoubleType(), True),
    ("period_label", StringType(), True),
)

DRY_SPELL = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("precipitation_mm", DoubleType(), True),
    ("temp_max", DoubleType(), True),
    ("weather_code", IntegerType(), True),
    ("is_rain_day", LongType(), True),
    ("dry_spell_days", LongType(), True),
    ("dry_spell_label", StringType(), True),
    ("max_dry_spell_so_far", LongType(), True),
)

TRAINING = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("temp_max", DoubleType(), True),
)

FORECAST = _struct(
    ("series", StringType(), True),
    ("ts", TimestampNTZType(), True),
    ("forecast", DoubleType(), True),
    ("lower_bound", DoubleType(), True),
    ("upper_bound", DoubleType(), True),
)

FINAL = _struct(
    ("city", StringType(), True),
    ("date", DateType(), True),
    ("actual", DoubleType(), True),
    ("forecast", DoubleType(), True),
    ("lower_bound", DoubleType(), True),
    ("upper_bound", DoubleType(), True),
)

METRICS = _struct(
    ("run_ts", TimestampNTZType(), True),
    ("series", StringType(), True),
    ("error_metric", StringType(), True),
    ("metric_value", DoubleType(), True),
)

#: What became of each series in a training run.
OUTCOMES = _struct(
    ("run_ts", TimestampNTZType(), True),
    ("series", StringType(), True),
    ("n_rows", LongType(), True),
    ("n", LongType(), True),
    ("sxx", DoubleType(), True),
    ("fitted", BooleanType(), True),
    ("fit_reason", StringType(), True),
    ("scored", BooleanType(), True),
    ("score_reason", StringType(), True),
)

#: Moments of (day, value) of a series in a month, and its newest points; see operators/moments.py.
POINT = _struct(("x", DoubleType(), True), ("y", DoubleType(), True))
MOMENTS = _struct(
    ("series", StringType(), True),
    ("n_rows", LongType(), True),
    ("n", LongType(), True),
    ("mean_x", DoubleType(), True),
    ("mean_y", DoubleType(), True),
    ("sxx", DoubleType(), True),
    ("syy", DoubleType(), True),
    ("sxy", DoubleType(), True),
    ("last_day", DateType(), True),
    ("points", ArrayType(POINT), True),
)

#: What the rolling models of the next month need to know of a series; see operators/carry.py.
CARRY = _struct(
    ("city", StringType(), True),
    ("temps", ArrayType(_struct(
        ("date", DateType(), True),
        ("temp_max", DoubleType(), True),
        ("temp_min", DoubleType(), True),
        ("temp_mean", DoubleType(), True),
    )), True),
    ("rain", ArrayType(_struct(("date", DateType(), True), ("precipitation_mm", DoubleType(), True))), True),
    ("dry_days", LongType(), True),
    ("longest", LongType(), True),
)

#: The columns of the event and shipment tables that observations derive from.
EVENTS = _struct(
    ("ts", TimestampNTZType(), True),
    ("user_id", LongType(), True),
    ("event_type", StringType(), True),
    ("value", DoubleType(), True),
    ("props", StringType(), True),
)

LINEITEM = _struct(
    ("l_suppkey", LongType(), True),
    ("l_linenumber", IntegerType(), True),
    ("l_quantity", DoubleType(), True),
    ("l_extendedprice", DoubleType(), True),
    ("l_returnflag", StringType(), True),
    ("l_shipdate", TimestampNTZType(), True),
)

#: Type-2 history of the fact table; a NULL ``valid_to`` marks the open row.
HISTORY = StructType(
    [StructField("row_key", StringType(), True)]
    + STAGE.fields
    + [
        StructField("valid_from", TimestampNTZType(), True),
        StructField("valid_to", TimestampNTZType(), True),
    ]
)
