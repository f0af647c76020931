from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = "The quick brown fox jumps over the lazy dog. " * 3000
PASSAGE = " ".join(f"passage{i} of words that repeat here." for i in range(12))

#: doc_id, text, lang, source
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta.", "en", "a"),
    (2, "ALPHA beta gamma delta epsilon zeta.", "en", "a"),
    (3, "alpha beta gamma delta epsilon zeta.", None, "b"),
    (4, None, "en", "b"),
    (5, "", None, None),
    (6, " \t\n ", "de", None),
    (7, LONG, "en", "a"),
    (8, LONG + "x", "en", "a"),
    (9, "ÉCOLE été çà 本 İ 🙂", "fr", "c"),
    (10, "école été çà 本 İ 🙂", "fr", "c"),
    (None, "a row without an id", "en", "c"),
    (11, "a row that repeats, id and all", "en", "a"),
    (11, "a row that repeats, id and all", "en", "a"),
    (12, "same id, one text", "en", "a"),
    (12, "same id, another text", "en", "b"),
    (13, "12345 67890 !!!", "de", "c"),
    (14, "Before it. " + PASSAGE + " After it.", "en", "a"),
    (15, "Another start here.\n" + PASSAGE + "\nAnother end.", "en", "b"),
    (16, "double  spaces \n and\ttabs  ", "en", "zz"),
    (-17, "one", "en", "zz"),
    (18, "½ ² ① 12 Ⅷ", "en", "zz"),
]

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names that the operators use inside.
        *[StructField(n, StringType()) for n in ("id", "row", "size", "digest", "hash", "ids", "found", "fp", "heavy", "word")],
    ]
)


def records(rows):
    return [(i, t, lang, s, None if t is None else len(t), *["other"] * 10) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(records(ROWS), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, data_dir):
    return spark.read.parquet(f"{data_dir}/documents.parquet")


def smallest_reachable(ids, pairs):
    """The smallest id that links reach, by plain union-find over positions."""
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in pairs:
        parent[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        r = root(i)
        known = [x for x in (least.get(r), own) if x is not None]
        least[r] = min(known) if known else None
    return [least[root(i)] for i in range(len(ids))]
