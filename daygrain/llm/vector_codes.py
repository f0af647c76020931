"""Compressing vectors to short codes of small codebooks, in integers.

Components become ``floor(256 * x)``, and a vector is cut into equal consecutive parts. Each
part position has a codebook, which begins as that part of the rows with the smallest ids
and moves in a few rounds: every part goes to its nearest entry (squared distance, ties to
the lower index), and an entry becomes the componentwise floor of the mean of its parts. A
vector's code is the index of its nearest entry, part by part.

Distances come from dictionaries. Within a chunk of rows each dimension has a dictionary of
the different integers that occur in it, and a table of the squared differences of each of
these to that dimension of all entries. The distance of a part to all entries is then a
gather from the tables of its dimensions by dictionary code, and a sum. A chunk has far
fewer different integers than rows, and never more, so tables stay bounded whatever the
values are.

Every round is one scan: a task adds up its parts per entry and returns one row per part
position and entry, and the driver holds the codebooks, which do not grow with the rows.

Rows whose vector is null or holds null or non-finite components are left out. Vectors that
are shorter than the longest one, or than a multiple of the number of parts, are filled with
zeros. Integers saturate at 2**27, so that errors fit a long. Of rows with one id, those
with the smaller vector come first; rows without an id come last. Fewer rows than entries
give fewer entries. Repeated rows each give a row; labels that are null together form a
label; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import stored, table
from daygrain.operators.series import meet

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Largest size of an integer component.
MOST = 1 << 27
#: Rows that share one set of dictionaries and tables.
CHUNK = 8192


def sound_rows(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector) of the rows whose vector holds numbers only."""
    whole = F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return vectors.filter(whole).select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )


def integers(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integer components, filled with zeros to ``width``."""
    sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = np.clip(np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * SCALE), -MOST, MOST)
    rows = np.zeros((len(vectors), width), np.int64)
    rows[np.arange(width)[None] < sizes[:, None]] = flat
    return rows


def nearest(rows: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry, per row and part.

    ``books`` is (parts, entries, components).
    """
    parts, entries, size = books.shape
    index, error = np.empty((len(rows), parts), np.int64), np.empty((len(rows), parts), np.int64)
    for part in range(parts):
        distance = np.zeros((len(rows), entries), np.int64)
        for k in range(size):
            values, codes = np.unique(rows[:, part * size + k], return_inverse=True)
            differences = values[:, None] - books[part, :, k][None]
            distance += (differences * differences)[codes]
        index[:, part] = distance.argmin(1)  # the first of equal ones
        error[:, part] = distance[np.arange(len(rows)), index[:, part]]
    return index, error


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def entry_sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, sums): number and componentwise sums of the parts nearest to each entry."""
    parts, entries, size = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(parts * entries, np.int64)
        sums = np.zeros((parts * entries, size), np.int64)
        for chunk in _chunks(batches):
            own = integers(chunk.column("vector"), parts * size)
            place = (nearest(own, books)[0] + np.arange(parts)[None] * entries).ravel()
            counts += np.bincount(place, minlength=len(counts))
            np.add.at(sums, place, own.reshape(-1, size))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(used // entries, pa.int32()),
                "entry": pa.array(used % entries, pa.int32()),
                "n": pa.array(counts[used], pa.int64()),
                "sums": pa.array(list(sums[used]), pa.list_(pa.int64())),
            }
        )

    per_task = rows.select("vector").mapInArrow(add_up, "part int, entry int, n long, sums array<long>")
    # Wide sums: a task's sums fit a long, those of all tasks need not.
    total = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(size)]
    return per_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total)


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the ``entries`` rows with the smallest ids."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    size = max(1, -(-width // parts))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    whole = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), parts * size)
    return whole.reshape(len(first), parts, size).transpose(1, 0, 2).copy()


def learn_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, components) after the given number of rounds."""
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        for r in entry_sums(rows, books).collect():  # at most a row per part and entry
            books[r["part"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(books.shape[2])]
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error): two hex digits per part, and the squared distances of all parts together."""
    parts, entries, size = books.shape
    if entries > 256:
        raise ValueError("a code has two hex digits per part, enough for 256 entries")
    schema = rows.select("id", "label").schema.add("code", "string").add("error", "long")

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            index, error = nearest(integers(chunk.column("vector"), parts * size), books)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("id"),
                    chunk.column("label"),
                    pa.array([row.tobytes().hex() for row in index.astype(np.uint8)], pa.string()),
                    pa.array(error.sum(1), pa.int64()),
                ],
                names=["id", "label", "code", "error"],
            )

    return rows.mapInArrow(codes, schema)


def decode(codes: DataFrame, books: np.ndarray, id: str = "id", code: str = "code") -> DataFrame:
    """(id, vector): the integer components that codes stand for."""
    # The books are read as one literal, by part and entry.
    literal = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in book]) for book in books])
    part_code = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
    parts = [F.element_at(literal, p + 1)[part_code(p)] for p in range(len(books))]
    return codes.select(F.col(id).alias("id"), F.concat(*parts).alias("vector"))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """The coded rows (id, label, code, error, label_error) and the codebooks.

    ``label_error`` is the error of all rows with an equal label.
    """
    rows = sound_rows(vectors, id, vector, label)
    books = learn_books(rows, parts, entries, rounds)
    # Written, so that vectors are coded once, and the join can split a label that most rows have.
    coded = stored(encode(rows, books), "codes")
    per_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    return meet(coded, per_label, ["label"]).select("id", "label", "code", "error", "label_error"), books


def op13(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def _round_sql(k: int) -> str:
    """One assignment to the books ``b{k}``, and the books after it."""
    return f"""
a{k} AS (
  SELECT r, p.part AS part, arg_min(entry, (d, entry)) AS entry, min(d) AS d, any_value(v) AS v
  FROM (SELECT p.r, p.part, b.entry, p.v,
               list_sum(list_transform(list_zip(p.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
        FROM parts p JOIN b{k} b USING (part)) p
  GROUP BY r, p.part),
s{k} AS (
  SELECT part, entry, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM a{k}, (SELECT unnest(range(1, 65)) AS i) WHERE i <= len(v) GROUP BY part, entry, i),
b{k + 1} AS (
  SELECT part, entry,
         CASE WHEN max(n) IS NULL THEN any_value(v)
              ELSE list((s - ((s % n) + n) % n) // n ORDER BY i) END AS v
  FROM b{k} LEFT JOIN s{k} USING (part, entry) GROUP BY part, entry)"""


#: For vectors of one length, a multiple of the number of parts, with ids that do not repeat.
OP13_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS part)),
b0 AS (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= {ENTRIES}),
{",".join(_round_sql(k) for k in range(ROUNDS + 1))},
coded AS (
  SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""
