"""Merge of a batch into a table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    load_ts: str | None = None,
    touch_on_update: bool = False,
) -> DataFrame:
    """The target after the merge: matched keys updated, new keys inserted.

    One full outer join on the key, hashed on all key columns. Batch values win,
    NULLs included. The load time is set on insert only, unless
    ``touch_on_update``. Both sides must have unique keys
    (:func:`daygrain.operators.checks.require_unique`).
    """
    keys = list(keys)
    values = [c for c in batch.columns if c not in keys and c != "load_ts"]
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    b = batch.withColumn("_in_batch", F.lit(True)).alias("b")
    joined = t.join(b, keys, "full_outer")
    in_batch = F.col("_in_batch").isNotNull()
    in_target = F.col("_in_target").isNotNull()

    now = _load_time(load_ts)
    keep = in_target & ~in_batch if touch_on_update else in_target
    merged = {
        name: F.when(in_batch, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}")) for name in values
    }
    merged["load_ts"] = F.when(keep, F.col("t.load_ts")).otherwise(now)
    return joined.select(
        *[F.col(c) if c in keys else merged[c].alias(c) for c in target.columns]
    )


def inserted(batch: DataFrame, schema: StructType, load_ts: str | None = None) -> DataFrame:
    """What :func:`upsert` makes of a batch none of whose keys the target has: no join, so no shuffle."""
    now = _load_time(load_ts)
    return batch.select(
        *[(now if f.name == "load_ts" else F.col(f.name).cast(f.dataType)).alias(f.name) for f in schema.fields]
    )


def _load_time(load_ts: str | None) -> Column:
    return (F.current_timestamp() if load_ts is None else F.lit(load_ts)).cast(TimestampNTZType())
