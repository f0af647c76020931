"""Contiguous shards of near-equal bytes, from global prefix sums.

Rows are laid out in the order of (hash of the text, id), so equal texts lie
side by side. Range partitioning gives every task one stretch of that order;
the byte and row totals of the stretches are added up, and each row's global
offset is its stretch's base plus a running sum inside the stretch. Cuts stand
at equal byte targets. A cut inside a group of equal texts moves to the nearer
edge of the group, if that is within ``snap`` of a shard; larger groups are cut
at the row whose middle passes the target.

Size is the UTF-8 length plus ``overhead``; a null text has length 0. The
result depends on ids and texts only, not on how the input was split. Rows that
repeat id and text are laid out side by side, each with its own slot. An empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.common import shuffle_partitions, stored, table, text_or_empty
from daygrain.llm.sql_hash import CRC_TABLE, crc32, signed, xxh64_of_texts

SHARDS = 40
OVERHEAD = 16
#: The share of a shard by which a cut may move to the edge of a group.
SNAP = 0.02
ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in so many bits


def laid_out(slim: DataFrame) -> DataFrame:
    """``slim`` (id, size, hash and more) with start, the bytes before each row, and row, the rows before it."""
    parts = shuffle_partitions(slim.sparkSession)
    placed = stored(
        slim.repartitionByRange(parts, "hash", "id", "size")
        .sortWithinPartitions("hash", "id", "size")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "placed",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # one row per partition
        placed.groupBy("part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base_rows"),
        )
    )
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("upto", F.sum("size").over(inside))
        .join(F.broadcast(bases), "part")
        .withColumn("start", F.col("base_bytes") + F.col("upto") - F.col("size"))
        .withColumn("row", F.col("base_rows") + F.col("at").bitwiseAND((1 << ROW_BITS) - 1))
        .drop("part", "at", "upto", "base_bytes", "base_rows")
    )


def cut_points(rows: DataFrame, n_shards: int, snap: float) -> list[int]:
    """Twice the byte offsets at which shards 1 to n begin; at most one row per cut reaches the driver."""
    total = rows.agg(F.max(F.col("start") + F.col("size"))).first()[0] or 0
    targets = [total * k // n_shards for k in range(1, n_shards)]
    if not total or not targets:
        return [2 * t for t in targets]
    wanted = F.array(*[F.lit(t).cast("long") for t in targets])
    end = F.col("start") + F.col("size")
    crossed = [r["hash"] for r in rows.filter(
        F.exists(wanted, lambda t: (F.col("start") < t) & (t < end))
    ).select("hash").distinct().collect()]
    groups = []
    if crossed:
        groups = sorted(
            (r["first"], r["last"])
            for r in rows.filter(F.col("hash").isin(crossed))
            .groupBy("hash")
            .agg(F.min("start").alias("first"), F.max(end).alias("last"))
            .collect()
        )
    cuts = []
    for target in targets:
        place = bisect_right([g[0] for g in groups], target) - 1
        cut = target
        if place >= 0 and groups[place][0] < target < groups[place][1]:
            edge = min(groups[place], key=lambda x: (abs(x - target), x))
            if abs(edge - target) <= snap * total / n_shards:
                cut = edge
        cuts.append(2 * cut)
    return cuts


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int = SHARDS,
    id: str = "doc_id",
    text: str = "text",
    overhead: int = OVERHEAD,
    snap: float = SNAP,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard and slot, the row's place in its shard.

    ``n_shards`` bounds the list of cuts that every task holds.
    """
    whole = text_or_empty(F.col(text))
    slim = stored(
        docs.select(
            F.col(id).alias("id"),
            (F.octet_length(whole) + overhead).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.xxhash64(whole).alias("hash"),
        ),
        "sizes",
    )
    rows = stored(laid_out(slim), "offsets")
    cuts = cut_points(rows, n_shards, snap)
    if cuts:
        ahead = F.array(*[F.lit(c).cast("long") for c in cuts])
        middle = 2 * F.col("start") + F.col("size")
        shard = F.size(F.filter(ahead, lambda c: c <= middle))
    else:
        shard = F.lit(0)
    rows = rows.withColumn("shard", shard.cast("int"))
    firsts = rows.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return rows.join(F.broadcast(firsts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")
    )


def op9(spark, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Running sums over the whole order, which the operator takes in range partitions.
OP9_SQL = f"""
WITH {CRC_TABLE},
{xxh64_of_texts("hashed", "SELECT coalesce(text, '') AS k FROM documents")},
sized AS (
  SELECT doc_id, strlen(k) + {OVERHEAD} AS size, ({crc32("k")})::BIGINT AS text_crc32, {signed("h")} AS hash
  FROM documents JOIN hashed ON k = coalesce(text, ''), crc),
laid AS (
  SELECT *, (sum(size) OVER (ORDER BY hash, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start,
         row_number() OVER (ORDER BY hash, doc_id NULLS FIRST, size) - 1 AS row
  FROM sized),
targets AS (
  SELECT total, total * k // {SHARDS} AS target
  FROM (SELECT sum(size)::BIGINT AS total FROM sized), (SELECT unnest(range(1, {SHARDS})) AS k)),
crossed AS (
  SELECT min(start) AS first, max(start + size) AS last FROM laid
  WHERE hash IN (SELECT hash FROM laid JOIN targets ON start < target AND target < start + size)
  GROUP BY hash),
edges AS (
  SELECT total, target, CASE WHEN target - first <= last - target THEN first ELSE last END AS edge
  FROM targets LEFT JOIN crossed ON first < target AND target < last),
cuts AS (
  SELECT CASE WHEN abs(edge - target) <= {SNAP}::DOUBLE * total / {SHARDS} THEN edge ELSE target END AS place FROM edges),
placed AS (
  SELECT *, (SELECT count(*) FROM cuts WHERE 2 * place <= 2 * start + size)::INTEGER AS shard FROM laid)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row - min(row) OVER (PARTITION BY shard) AS slot,
       NULL::INTEGER AS grown_shard
FROM placed
"""
