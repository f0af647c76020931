"""Daily observations derived from event and shipment tables.

Both give the fact-table schema with one row per series and day. The only
shuffle is the aggregation itself: it groups on the integer key and the day,
so rows are pre-aggregated before they move and a series that holds a large
share of the events is spread over its days. Shipments hardly repeat a key, so
a large table of them moves as it is, to as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.functions import round_half_up
from daygrain.schemas import EVENTS, LINEITEM, OBSERVATIONS


#: Rows that one task groups; what it holds in memory follows from this alone.
ROWS_A_TASK = 500_000


def ship_tasks(spark: SparkSession, data_dir: str) -> int | None:
    """Tasks that the rows of ``lineitem`` need, counted from its footers; None for a table that fits one."""
    rows = spark.read.schema(LINEITEM).parquet(f"{data_dir}/lineitem.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)) if rows > ROWS_A_TASK else None


def daily_obs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Observations per user and day from ``events``."""
    events = spark.read.schema(EVENTS).parquet(f"{data_dir}/events.parquet").select(
        "user_id",
        "event_type",
        "value",
        "ts",
        F.col("ts").cast("date").alias("date"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
    measured = F.when(F.col("event_type") != "error", F.col("value"))
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    # Only numbers are aggregated: text in an aggregation buffer would force a sort.
    signup = F.when(F.col("event_type") == "signup", F.lit(1))
    only_signup = (F.col("n") == 1) & (F.col("n_signup") == 1)
    daily = events.groupBy("user_id", "date").agg(
        F.max(measured).alias("temp_max"),
        F.min(measured).alias("temp_min"),
        F.avg(measured).alias("temp_mean"),
        F.sum(bought).alias("bought"),
        F.max("k").alias("k_max"),
        F.min("k").alias("k_min"),
        F.max("ts").alias("load_ts"),
        F.count(F.lit(1)).alias("n"),
        F.count(signup).alias("n_signup"),
    )
    rain = F.when(~only_signup, round_half_up(F.coalesce("bought", F.lit(0.0)), 2))
    return daily.select(
        F.concat(F.lit("S_"), F.col("user_id").cast("string")).alias("city"),
        (25 + F.col("user_id") % 25).cast("double").alias("latitude"),
        (-70 - F.col("user_id") % 50).cast("double").alias("longitude"),
        "date",
        "temp_max",
        "temp_min",
        round_half_up("temp_mean", 2).alias("temp_mean"),
        rain.alias("precipitation_mm"),
        F.col("k_max").cast("double").alias("wind_speed_max_kmh"),
        F.col("k_min").alias("weather_code"),
        "load_ts",
    ).select(*OBSERVATIONS.names)


def daily_ship(spark: SparkSession, data_dir: str) -> DataFrame:
    """Observations per supplier and ship day from ``lineitem``: long series."""
    lines = spark.read.schema(LINEITEM).parquet(f"{data_dir}/lineitem.parquet").select(
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("date"),
        "l_shipdate",
        "l_extendedprice",
        "l_quantity",
        "l_linenumber",
        "l_returnflag",
    )
    tasks = ship_tasks(spark, data_dir)
    if tasks:
        lines = lines.repartition(tasks, "l_suppkey", "date")
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    daily = lines.groupBy("l_suppkey", "date").agg(
        F.max("l_extendedprice").alias("temp_max"),
        F.min("l_extendedprice").alias("temp_min"),
        F.avg("l_extendedprice").alias("temp_mean"),
        F.sum(returned).alias("returned"),
        F.max("l_quantity").alias("wind_speed_max_kmh"),
        F.min("l_linenumber").cast("int").alias("weather_code"),
        F.max("l_shipdate").alias("load_ts"),
    )
    return daily.select(
        F.concat(F.lit("P_"), F.col("l_suppkey").cast("string")).alias("city"),
        (25 + F.col("l_suppkey") % 25).cast("double").alias("latitude"),
        (-70 - F.col("l_suppkey") % 50).cast("double").alias("longitude"),
        "date",
        "temp_max",
        "temp_min",
        round_half_up("temp_mean", 2).alias("temp_mean"),
        round_half_up(F.coalesce("returned", F.lit(0.0)), 2).alias("precipitation_mm"),
        "wind_speed_max_kmh",
        "weather_code",
        "load_ts",
    ).select(*OBSERVATIONS.names)
