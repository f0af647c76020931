"""Exact dedup with a heavy-hitter split.

Misra-Gries counters (``freqItems``) name the digests that may hold more than a
given share of the rows. Their exact counts and winners, at most ``1 / support``
rows, are broadcast, so copies of them are settled where they lie. All other
digests, none of which holds more than that share, are grouped by a shuffle.

Texts are equal when identical after lower-casing A-Z only; a null text counts
as empty. Of equal texts the row with the largest id stays; a null id ranks
below every other. Of rows that repeat both id and text one stays. An empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.common import ascii_lower, stored, table

#: Share of all rows from which a digest counts as a heavy hitter.
SUPPORT = 0.001


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(text).cast("binary"), 256))


def heavy_digests(slim: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, group_size, keep_id, keep_row) of the digests that hold at least ``support`` of the rows.

    ``slim`` has id, digest and row. The counters run over a 64-bit hash of the
    digest; the exact count that follows drops false candidates. No more than
    ``1 / support`` digests can pass it.
    """
    hashed = slim.withColumn("hash", F.xxhash64("digest"))
    candidates = hashed.stat.freqItems(["hash"], support).select(F.explode("hash_freqItems").alias("hash"))
    least = max(2, slim.count() * support)
    return stored(
        hashed.join(F.broadcast(candidates), "hash", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("best"))
        .filter(F.col("group_size") >= least)
        .select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")),
        "heavy",
    )


def label_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept and digest."""
    slim = stored(
        docs.select(F.col(id).alias("id"), text_digest(F.col(text)).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "digests",
    )
    heavy = F.broadcast(heavy_digests(slim, support))
    settled = slim.join(heavy, "digest")
    rest = slim.join(heavy, "digest", "left_anti")
    groups = (
        rest.groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("id", "row")).alias("best"))
        .select("digest", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    )
    columns = ["id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"]
    return settled.select(*columns).union(rest.join(groups, "digest").select(*columns))


def drop_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Losing copies of heavy digests go before the shuffle; of the rest, each
    task forwards at most one row per digest.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc")).select(
        "doc", F.col(f"doc.{id}").alias("id"), text_digest(F.col(f"doc.{text}")).alias("digest")
    )
    slim = stored(
        docs.select(F.col(id).alias("id"), text_digest(F.col(text)).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "digests",
    )
    heavy = heavy_digests(slim, support).select("digest", "keep_id", F.lit(True).alias("heavy"))
    left = rows.join(F.broadcast(heavy), "digest", "left").filter(
        F.col("heavy").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))
    )
    first = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    return left.withColumn("place", F.row_number().over(first)).filter("place = 1").select("doc.*")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return label_duplicates(docs).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


OP4_SQL = """
WITH normal AS (
  SELECT doc_id,
         sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM normal
"""
