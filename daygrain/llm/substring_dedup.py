"""Substring dedup by hashing lines cut at sentence ends.

A text is cut into units: lines, and lines at sentence ends, so that a passage
set into another line still gives whole units. A unit is normalised (lower
case, single spaces, no outer spaces) and hashed with XXH64; units are grouped by
digest over all documents, and the earliest occurrence in the order of id, then
position, is kept. Every other occurrence is a repeat. Repeats that follow each
other in a document form a passage, and passages of at least ``min_words`` words
are removed; shorter ones, such as a common phrase, stay. Offsets are
characters of the original text, end exclusive, and cover the white space after
the passage.

A null or blank text has no units. Rows that repeat id and text count as one
document, and each returns the same result; a null id ranks last. An empty
table gives an empty result; other columns are never looked at. Documents are
told apart by id and a 64-bit hash of the text.

A frequent unit is counted before it is shuffled. Counts and passages are written
before they are joined back: adaptive execution splits a hot digest, or a hot
document, only where the other side of the join does not come straight from an
aggregation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from daygrain.llm.common import stored, table, text_or_empty

MIN_WORDS = 20

#: A unit runs to the end of its line or sentence and takes the white space that follows.
UNIT = re.compile(r"[^.!?\n]*+(?:[.!?]++(?=\s|$)|[.!?\n])\s*+|[^.!?\n]++\Z")

UNITS = "id long, text_hash long, pos int, head int, tail int, words int, digest long, nth int"


def cut_units(text: str | None) -> Iterator[tuple[int, int, int, int]]:
    """(head, tail, words, digest) of each unit that has a word."""
    for match in UNIT.finditer(text or ""):
        words = match.group().lower().split()
        if words:
            yield match.start(), match.end(), len(words), _signed(xxhash.xxh64_intdigest(" ".join(words)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _unit_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The units of each document after a row with pos -1 that counts them."""
    names = [c.split()[0] for c in UNITS.split(", ")]
    for frame in frames:
        rows = []
        for id, text_hash, text in zip(frame.id, frame.text_hash, frame.text):
            id, seen, at = None if pd.isna(id) else id, {}, len(rows)
            rows.append(None)
            words = 0
            for pos, (head, tail, n, digest) in enumerate(cut_units(text)):
                nth = seen[digest] = seen.get(digest, -1) + 1
                words += n
                rows.append((id, text_hash, pos, head, tail, n, digest, nth))
            rows[at] = (id, text_hash, -1, 0, len(text or ""), words, None, len(rows) - at - 1)
            if len(rows) > 50_000:
                yield _framed(rows, names)
                rows = []
                continue
        if rows:
            yield _framed(rows, names)


def _framed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"id": "Int64", "digest": "Int64"})


def found_units(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The units of every row of ``docs``, and a row with pos -1 that counts them; written."""
    whole = F.col(text)
    source = docs.select(F.col(id).alias("id"), F.xxhash64(text_or_empty(whole)).alias("text_hash"), whole.alias("text"))
    return stored(source.mapInPandas(_unit_rows, UNITS), "units")


def repeats(bodies: DataFrame) -> DataFrame:
    """The units that are not the earliest of their digest, with the smallest id that has it."""
    counts = bodies.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("keep_id"))
    repeated = stored(counts.filter("n > 1").drop("n"), "repeated")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0)
    return bodies.join(repeated, "digest").filter(~kept)


def repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, n_units, n_words, n_chars, removed and removed_chars.

    ``removed`` lists the passages to remove in order: head, tail, words and
    keep_id, the smallest id that keeps one of its units.
    """
    units = found_units(docs, id, text)
    later = repeats(units.filter("pos >= 0")).dropDuplicates(["id", "text_hash", "pos"])
    order = Window.partitionBy("id", "text_hash").orderBy("pos")
    passages = (
        later.withColumn("run", F.col("pos") - F.row_number().over(order))
        .groupBy("id", "text_hash", "run")
        .agg(F.min("head").alias("head"), F.max("tail").alias("tail"), F.sum("words").cast("int").alias("words"),
             F.min("keep_id").alias("keep_id"))
        .filter(F.col("words") >= min_words)
    )
    per_document = passages.groupBy(F.col("id").alias("rid"), F.col("text_hash").alias("rhash")).agg(
        F.array_sort(F.collect_list(F.struct("head", "tail", "words", "keep_id"))).alias("removed"),
        F.sum(F.col("tail") - F.col("head")).alias("removed_chars"),
    )
    removed = stored(per_document, "passages")
    heads = units.filter("pos < 0").select(
        "id", "text_hash", F.col("nth").alias("n_units"), F.col("words").alias("n_words"), F.col("tail").alias("n_chars")
    )
    return (
        heads.join(removed, (F.col("text_hash") == F.col("rhash")) & F.col("id").eqNullSafe(F.col("rid")), "left")
        .drop("rid", "rhash")
        .withColumn("removed", F.coalesce("removed", F.array().cast(removed.schema["removed"].dataType)))
        .withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0)))
    )


@F.pandas_udf(StringType())
def without(texts: pd.Series, removed: pd.Series) -> pd.Series:
    """Texts without the passages named by ``removed``."""

    def cut(text, spans):
        if text is None or spans is None:
            return text
        kept, at = [], 0
        for span in spans:
            kept.append(text[at : span["head"]])
            at = span["tail"]
        return "".join(kept) + text[at:]

    return pd.Series([cut(t, s) for t, s in zip(texts, removed)])


def cleaned(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without their repeated passages, with the same columns."""
    found = (
        repeated_passages(docs, id, text, min_words)
        .filter(F.size("removed") > 0)
        .select(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash"), "removed")
        .dropDuplicates(["found_id", "found_hash"])
    )
    rows = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("own_hash", F.xxhash64(text_or_empty(F.col(f"doc.{text}"))))
    same = (F.col("own_hash") == F.col("found_hash")) & F.col(f"doc.{id}").eqNullSafe(F.col("found_id"))
    joined = rows.join(found, same, "left")
    return joined.select(*[
        without(F.col(f"doc.{c}"), F.col("removed")).alias(c) if c == text else F.col("doc").getField(c).alias(c)
        for c in docs.columns
    ])


def listed(removed: Column) -> Column:
    """Passages as ``head:tail:words:keep_id``, joined by commas; a null id is left out."""
    parts = F.transform(removed, lambda p: F.concat_ws(":", p["head"], p["tail"], p["words"], p["keep_id"]))
    return F.array_join(parts, ",")


def op3(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_units",
        "n_words",
        "n_chars",
        F.size("removed").alias("n_removed"),
        F.col("removed_chars").cast("long").alias("removed_chars"),
        listed(F.col("removed")).alias("removed"),
    )


#: Fixed value: white space as Python has it.
_BLANK = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_UNIT_SQL = rf"[^.!?\n]*(?:[.!?]+[{_BLANK}]+|[.!?]+\z|[.!?\n])[{_BLANK}]*|[^.!?\n]+\z"

#: Units as texts in place of digests. Letters whose lower case has several characters are not looked after.
OP3_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents)),
cuts AS (
  SELECT d, doc_id, unnest(units) AS unit, generate_subscripts(units, 1) AS nr
  FROM (SELECT d, doc_id, regexp_extract_all(text, '{_UNIT_SQL}') AS units FROM docs)),
measured AS (
  SELECT d, doc_id, nr, length(unit) AS chars, regexp_extract_all(lower(unit), '[^{_BLANK}]+') AS w,
         sum(length(unit)) OVER (PARTITION BY d ORDER BY nr ROWS UNBOUNDED PRECEDING) AS tail
  FROM cuts),
units AS (
  SELECT d, doc_id, row_number() OVER (PARTITION BY d ORDER BY nr) AS pos, tail - chars AS head, tail,
         len(w) AS words, array_to_string(w, ' ') AS said
  FROM measured WHERE len(w) > 0),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY d, said ORDER BY pos) AS nth, min(doc_id) OVER (PARTITION BY said) AS keep_id
  FROM units),
later AS (
  SELECT *, pos - row_number() OVER (PARTITION BY d ORDER BY pos) AS run
  FROM marked WHERE nth > 1 OR doc_id IS DISTINCT FROM keep_id),
passages AS (
  SELECT d, min(head) AS head, max(tail) AS tail, sum(words) AS words, min(keep_id) AS keep_id
  FROM later GROUP BY d, run HAVING sum(words) >= {MIN_WORDS}),
removed AS (
  SELECT d, count(*) AS n, sum(tail - head) AS chars,
         string_agg(concat_ws(':', head, tail, words, keep_id), ',' ORDER BY head) AS removed
  FROM passages GROUP BY d),
sizes AS (SELECT d, count(*) AS n_units, sum(words) AS n_words FROM units GROUP BY d)
SELECT o.doc_id, coalesce(n_units, 0)::INTEGER AS n_units, coalesce(n_words, 0)::INTEGER AS n_words,
       coalesce(length(o.text), 0)::INTEGER AS n_chars, coalesce(n, 0)::INTEGER AS n_removed,
       coalesce(chars, 0)::BIGINT AS removed_chars, coalesce(removed, '') AS removed
FROM documents o
JOIN docs ON docs.doc_id IS NOT DISTINCT FROM o.doc_id AND docs.text IS NOT DISTINCT FROM o.text
LEFT JOIN sizes USING (d) LEFT JOIN removed USING (d)
"""
