"""Tables with a declared schema, key, required columns and defaults.

The declaration lies beside the table's data as ``_declared/table.json``. It is applied
wherever files of the table are written, whoever writes them: columns are taken by name and
cast, missing ones and, where a default is declared, missing values get the default, and the
written files are checked before the commit that would make them visible. A commit with a
repeated key or a missing required value is refused and leaves the table as it was.

A commit replaces whole months, so a key that holds the day the months come from (or a log's
run) is unique in the table if it is unique in every commit.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrain.operators.checks import CheckFailed
from daygrain.sources.files import children, delete, read_text, write_text

_FOLDER = "_declared"
_FILE = "table.json"
#: Columns that say where a row is stored.
_PLACES = ("month", "run")


@dataclass(frozen=True)
class Declaration:
    """``defaults`` maps a column to a SQL expression, such as ``current_timestamp()``."""

    schema: StructType
    key: Sequence[str] = ()
    not_null: Sequence[str] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        unknown = {*self.key, *self.not_null, *self.defaults} - set(self.schema.names)
        if unknown:
            raise ValueError(f"not in the schema: {sorted(unknown)}")

    @property
    def required(self) -> list[str]:
        return [c for c in self.schema.names if c in {*self.key, *self.not_null}]


def declare(spark: SparkSession, path: str, table: Declaration, replace: bool = False) -> None:
    """Keep a declaration with the table at ``path``; one that is there stays, unless replaced.

    Rows that were stored before are not checked.
    """
    if declaration(spark, path) is not None:
        if not replace:
            return
        delete(spark, f"{path}/{_FOLDER}/{_FILE}")
    text = json.dumps(
        {
            "schema": table.schema.jsonValue(),
            "key": list(table.key),
            "not_null": list(table.not_null),
            "defaults": dict(table.defaults),
        }
    )
    write_text(spark, f"{path}/{_FOLDER}/{_FILE}", text)


def declaration(spark: SparkSession, path: str) -> Declaration | None:
    if _FILE not in children(spark, f"{path}/{_FOLDER}"):
        return None
    found = json.loads(read_text(spark, f"{path}/{_FOLDER}/{_FILE}"))
    return Declaration(StructType.fromJson(found["schema"]), found["key"], found["not_null"], found["defaults"])


def conformed(df: DataFrame, path: str) -> DataFrame:
    """Rows as declared: columns by name and type, defaults filled in; as they are if nothing is declared."""
    table = declaration(df.sparkSession, path)
    if table is None:
        return df
    strange = set(df.columns) - set(table.schema.names) - set(_PLACES)
    if strange:
        raise CheckFailed(f"columns that {path} does not have: {sorted(strange)}")
    columns = []
    for f in table.schema.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        value = value.cast(f.dataType)
        if f.name in table.defaults:
            value = F.coalesce(value, F.expr(table.defaults[f.name]).cast(f.dataType))
        columns.append(value.alias(f.name))
    return df.select(*columns, *[c for c in _PLACES if c in df.columns and c not in table.schema.names])


def require_sound(spark: SparkSession, path: str, folder: str, schema: StructType) -> None:
    """Raise if files that were written but not committed break the declaration.

    Reads the key and the required columns of the new files only.
    """
    table = declaration(spark, path)
    if table is None or not table.required:
        return
    rows = spark.read.schema(schema).parquet(folder).select(*table.required)
    missing = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.required]).first()
    empty = {c: missing[c] for c in table.required if missing[c]}
    if empty:
        raise CheckFailed(f"missing values in required columns of {path}: {empty}")
    if table.key:
        twice = rows.groupBy(*table.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*table.key).first()
        if twice is not None:
            raise CheckFailed(f"repeated key in {path}: {twice.asDict()}")
