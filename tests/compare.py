"""Compare a Spark result with a DuckDB result, value by value."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(data_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {f.name: _TYPES.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    if expected_types != actual_types:
        return [f"schema: spark {actual_types} / sql {expected_types}"]
    expected = rows_of(relation.columns, relation.fetchall())
    actual = rows_of(df.columns, df.collect())
    if not sum(expected.values()):
        return ["the SQL gives no rows"]
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return []
    return [
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"{sum(missing.values())} missing, {sum(extra.values())} extra; "
        f"for example missing {sorted(missing, key=str)[:3]} extra {sorted(extra, key=str)[:3]}"
    ]
