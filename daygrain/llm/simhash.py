"""SimHash near-dedup by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints at most three
bits apart differ in at most one bit of some segment, so every fingerprint
enumerates the Hamming ball of radius one around each segment, fetches the
fingerprints filed under those values, and the full distance decides. Of two
values one bit apart only one has a 0 there, so it is enough to flip zeros.

Copies share a fingerprint and are filed once. A segment value that files more
than ``HOT_BUCKET`` different fingerprints, as large groups of near copies make,
is not joined pair by pair: its fingerprints and those that probe it are
compared in one group, which returns a spanning forest of the links instead of
the links. From ``GIANT_BUCKET`` fingerprints on, such a group is filed anew by
16 bits of the other segment; 48 fixed bits leave at most 65,536 fingerprints.

Words are runs of anything but ASCII white space after lower-casing A-Z; shingles
of ``shingle`` words are hashed with XXH64, repeats included. A text with fewer
words is one shingle, one without words (also null) has fingerprint zero and is
linked like any other. Rows that repeat an id or a text are rows of their own;
a null id is never the smallest while another is there. An empty table gives an
empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrain.llm.common import LOWER, UPPER, WORD, stored, table, text_or_empty
from daygrain.llm.graph import Forest, components
from daygrain.llm.sql_hash import xxh64_of_texts

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT_BUCKET = 64
GIANT_BUCKET = 20_000
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()[min(shingle, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """(id, fp) and ``keep`` per row, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id).alias("id"), of_texts(F.col(text)).alias("fp"), *keep)


def _segments(fp: Column) -> Column:
    """The two 32-bit segments as (segment, value)."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return F.array(
        F.struct(F.lit(0).cast("byte").alias("segment"), low.alias("value")),
        F.struct(F.lit(1).cast("byte").alias("segment"), F.shiftrightunsigned(fp, 32).alias("value")),
    )


def _raised(value: Column, bits: int) -> Column:
    """``value`` with one of its zeros turned to one, for each zero."""
    powers = [F.lit(1 << b).cast("long") for b in range(bits)]
    free = F.filter(F.array(*powers), lambda p: value.bitwiseAND(p) == 0)
    return F.transform(free, lambda p: value.bitwiseOR(p))


def _lowered(value: Column, bits: int) -> Column:
    powers = [F.lit(1 << b).cast("long") for b in range(bits)]
    held = F.filter(F.array(*powers), lambda p: value.bitwiseAND(p) != 0)
    return F.transform(held, lambda p: value.bitwiseXOR(p))


def bucket_forest(group: pd.DataFrame, max_bits: int = MAX_BITS) -> pd.DataFrame:
    """Links inside one bucket as forest edges: filed fingerprints with each other and with those that probe it."""
    fps = np.concatenate([group.fp[group.filed].unique(), group.fp[~group.filed].unique()])
    filed = fps[: group.fp[group.filed].nunique()].view(np.uint64)
    forest, rows = Forest(len(fps)), max(1, (1 << 22) // max(1, len(filed)))
    for at in range(0, len(fps), rows):
        near = np.bitwise_count(fps[at : at + rows].view(np.uint64)[:, None] ^ filed[None, :]) <= max_bits
        for i in np.flatnonzero(near.any(1)):
            forest.link(at + i, np.flatnonzero(near[i]))
    nodes, roots = forest.edges()
    return pd.DataFrame({"a": fps[nodes], "b": fps[roots]})


def links(
    distinct: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET, giant: int = GIANT_BUCKET
) -> DataFrame:
    """Edges (a, b) that connect every two fingerprints at most ``max_bits`` (3 or fewer) apart.

    ``distinct`` is a written table of different fingerprints, ``fp``.
    """
    if max_bits > 3:
        raise ValueError("two segments with one flipped bit find at most 3 differing bits")
    filed = distinct.select("fp", F.inline(_segments(F.col("fp"))))
    probes = filed.select("fp", "segment", F.explode(_raised(F.col("value"), 32)).alias("value"))
    crowded = stored(filed.groupBy("segment", "value").count().filter(F.col("count") > hot), "crowded")
    keys = ["segment", "value"]

    quiet = filed.join(crowded, keys, "left_anti").withColumnRenamed("fp", "b")
    asked = probes.unionByName(filed).withColumnRenamed("fp", "a")
    pairs = asked.join(quiet, keys).filter(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    ).select("a", "b")

    busy = crowded.select(*keys, (F.col("count") > giant).alias("is_giant"))
    members = filed.withColumn("filed", F.lit(True)).unionByName(probes.withColumn("filed", F.lit(False))).join(busy, keys)
    inside = members.filter("NOT is_giant").groupBy(*keys).applyInPandas(
        lambda group: bucket_forest(group, max_bits), "a long, b long"
    )
    other = F.when(F.col("segment") == 0, F.shiftrightunsigned("fp", 32)).otherwise(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    )
    halves = F.array(*[
        F.struct(F.lit(h).alias("half"), F.shiftrightunsigned(other, 16 * h).bitwiseAND(F.lit(0xFFFF).cast("long")).alias("part"))
        for h in (0, 1)
    ])
    split = members.filter("is_giant").select("*", F.inline(halves))
    around = F.when(F.col("filed"), F.array("part")).otherwise(
        F.concat(F.array("part"), _raised(F.col("part"), 16), _lowered(F.col("part"), 16))
    )
    mutual = split.filter("filed").withColumn("filed", F.lit(False))  # members of a giant also probe it
    giants = (
        split.unionByName(mutual)
        .withColumn("part", F.explode(around))
        .groupBy(*keys, "half", "part")
        .applyInPandas(lambda group: bucket_forest(group, max_bits), "a long, b long")
    )
    # A fingerprint of a giant bucket meets itself, as it is filed there and probes it.
    return pairs.union(inside).union(giants).filter("a <> b")


def grouped(
    docs: DataFrame, id: str, text: str, shingle: int, max_bits: int, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """One row per row of ``docs``: id, fp, ``keep``, component and root, a fingerprint that names the group."""
    prints = stored(fingerprints(docs, id, text, shingle, keep), "prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct, max_bits))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    return prints.join(placed.join(least, "root").select("fp", "component", "root"), "fp")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``docs``: id, fp and component, the smallest id that links reach."""
    return grouped(docs, id, text, shingle, max_bits).select("id", "fp", "component")


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of ``docs`` for each group, that with the smallest id, with all its columns.

    A null id stays only where the group has no other. Of rows that share that
    id the one with the smallest digest of id and text stays, of equal ones any.
    """

    def key(of_id: Column, of_text: Column) -> Column:
        named = F.coalesce(F.concat(F.lit("="), of_id.cast("string")), F.lit(""))
        return F.unhex(F.sha2(F.concat(named, F.lit("\0"), text_or_empty(of_text)).cast("binary"), 256))

    found = grouped(docs, id, text, shingle, max_bits, (key(F.col(id), F.col(text)).alias("key"),))
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("best")
    ).select("best.key")
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    rows = rows.withColumn("key", key(F.col(f"doc.{id}"), F.col(f"doc.{text}"))).join(kept, "key", "left_semi")
    copies = Window.partitionBy("key").orderBy("key")  # the join's partitioning and sort
    return rows.withColumn("copy", F.row_number().over(copies)).filter("copy = 1").select("doc.*")


def op7(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


#: All pairs of different fingerprints, and a walk along their links.
OP7_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
shingles AS (
  SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE} - 1], ' ')) END) AS k
  FROM rows),
{xxh64_of_texts("hashed", "SELECT k FROM shingles", SEED)},
counted AS (
  SELECT r, {" + ".join(f"(CASE WHEN 2 * count_if(h & {1 << i}::UBIGINT <> 0) > count(*) THEN {1 << i}::UBIGINT ELSE 0 END)" for i in range(64))} AS fp
  FROM shingles JOIN hashed USING (k) GROUP BY r),
prints AS MATERIALIZED (SELECT doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM rows LEFT JOIN counted USING (r)),
links AS MATERIALIZED (
  SELECT a.fp AS a, b.fp AS b
  FROM (SELECT DISTINCT fp FROM prints) a JOIN (SELECT DISTINCT fp FROM prints) b
    ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)) <= {MAX_BITS}),
reached AS (
  SELECT DISTINCT fp, fp AS other FROM prints
  UNION SELECT r.fp, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (
  SELECT r.fp, min(p.doc_id) AS component_id FROM reached r JOIN prints p ON p.fp = r.other GROUP BY r.fp)
SELECT doc_id, format('{{:016x}}', fp) AS fingerprint, component_id FROM prints JOIN least USING (fp)
"""
