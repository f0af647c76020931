"""The hashes spelled out in SQL against libraries, for every length around a stripe."""

import zlib

import duckdb
import xxhash

from pyspark.sql import functions as F

from daygrain.llm.sql_hash import CRC_TABLE, crc32, signed, xxh64_of_int, xxh64_of_long, xxh64_of_texts

TEXTS = ["x" * n for n in range(70)] + [("é∂" * 40)[:n] + "\U0001f600" for n in range(40)] + ["a\0b", "ab" * 5000]


def held(query: str):
    con = duckdb.connect()
    con.execute("CREATE TABLE texts (k VARCHAR)")
    con.executemany("INSERT INTO texts VALUES (?)", [[t] for t in TEXTS])
    return con.sql(query).fetchall()


def test_xxh64_is_that_of_the_library():
    rows = held(f"WITH {xxh64_of_texts('hashed', 'SELECT k FROM texts')} SELECT k, h, {signed('h')} FROM hashed")
    assert len(rows) == len(set(TEXTS))
    for text, unsigned, with_sign in rows:
        expected = xxhash.xxh64_intdigest(text.encode(), 42)
        assert unsigned == expected
        assert with_sign == (expected - (1 << 64) if expected >> 63 else expected)


def test_crc32_is_that_of_the_library():
    rows = held(f"WITH {CRC_TABLE} SELECT k, {crc32('k')} FROM texts, crc")
    assert len(rows) == len(TEXTS)
    assert all(value == zlib.crc32(text.encode()) for text, value in rows)


def test_hashes_of_several_columns_are_those_of_spark(spark):
    numbers = [(n, m) for n in (0, 1, 7, 2**31 - 1) for m in (None, 0, 1, -1, 2**63 - 1, -(2**63), 123456789012)]
    df = spark.createDataFrame(numbers, "n int, m long").select("n", "m", F.xxhash64("n", "m").alias("h"))
    con = duckdb.connect()
    con.execute("CREATE TABLE numbers (n INTEGER, m BIGINT)")
    con.executemany("INSERT INTO numbers VALUES (?, ?)", numbers)
    chained = xxh64_of_long("m", f"({xxh64_of_int('n')})")
    rows = con.sql(f"SELECT n, m, {signed('h')} FROM (SELECT *, {chained} AS h FROM numbers)").fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in df.collect())
