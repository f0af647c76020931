"""Ingest of the payload files that landed since the last run.

The daily load again, with Structured Streaming keeping the list of files already
taken: the query takes what has landed, upserts it and stops. The upsert is
idempotent, so a micro-batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from daygrain.operators.checks import require_unique
from daygrain.sources.payloads import (
    attach_series,
    conform,
    flatten_daily,
    newest_fetch,
    read_series,
    stream_payloads,
)
from daygrain.sources.tables import upsert_observations


def ingest_landed(
    spark: SparkSession,
    landing: str,
    series_path: str,
    table: str,
    checkpoint: str,
    load_ts: str,
) -> None:
    """Upsert every payload file not seen before, then stop.

    ``checkpoint`` is this ingest's own folder in shared storage.
    """

    def merge(payloads: DataFrame, _: int) -> None:
        rows = flatten_daily(payloads).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            require_unique(rows, ["city", "date", "fetch"])
            series = read_series(rows.sparkSession, series_path)
            batch = conform(attach_series(newest_fetch(rows), series))
            upsert_observations(rows.sparkSession, table, batch, load_ts)
        finally:
            rows.unpersist()

    query = (
        stream_payloads(spark, landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
