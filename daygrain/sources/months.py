"""Tables stored by month (or logs by run), where a commit is the creation of one small file.

Under a table's path lie

    batch=00000007-<id>/month=2026-03-01/part-*.parquet   written once, never changed
    _manifest/00000007.json                               month folder -> batch folder

A commit writes the months it touches into a new batch folder, then renames one
manifest into place that names, for every month of the table, the batch that holds
it. Readers resolve the newest manifest once, so they see the table before or after
a commit and never a mix. A commit cut off at any step leaves the table as it was,
and repeating it gives what an undisturbed run gives. One writer at a time; a second
one finds its manifest number taken and fails. Commits over several tables are in
:mod:`daygrain.sources.release`.

A log is stored the same way with ``run=...`` in place of months, so a run that is
repeated replaces its own rows.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from daygrain.sources import declared
from daygrain.sources.files import COMPRESSED, children, delete, filesystem, read_text, size, write_text

#: Stored bytes of the months that are worked on at once, where months can be taken one after the other.
RUN_BYTES = 64 << 20
#: Commits whose files stay, so that readers of the one before last finish undisturbed.
KEPT_COMMITS = 2

MONTH = StructField("month", DateType(), True)
RUN = StructField("run", StringType(), True)
_BATCH = StructField("batch", StringType(), True)
_MANIFESTS = "_manifest"
_NO_MONTH = "month=__HIVE_DEFAULT_PARTITION__"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{path}/{_MANIFESTS}")
    return [int(name[:8]) for name in names if re.fullmatch(r"\d{8}\.json", name)]


def _read_manifest(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{path}/{_MANIFESTS}/{number:08d}.json"))


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and content of the newest manifest; 0 and nothing before the first commit."""
    numbers = _numbers(spark, path)
    return (numbers[-1], _read_manifest(spark, path, numbers[-1])) if numbers else (0, {})


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def new_batch(spark: SparkSession, path: str) -> str:
    """Name of a folder for the next commit's files."""
    return f"batch={manifest(spark, path)[0] + 1:08d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, path: str, batch: str) -> int:
    """Make the months of a written batch those of the table; returns the commit's number."""
    number, entries = manifest(spark, path)
    switch(spark, path, number + 1, {**entries, **written(spark, path, batch)})
    tidy(spark, path)
    return number + 1


def written(spark: SparkSession, path: str, batch: str) -> dict[str, str]:
    """The entries that a written batch adds to a manifest."""
    return {name: batch for name in children(spark, f"{path}/{batch}") if _is_part(name)}


def _is_part(name: str) -> bool:
    return name.startswith(("month=", "run="))


#: Before a part's name: the key under which a manifest keeps what the part was derived from.
_FROM = "from "


def derived_from(entries: dict[str, str], part: str) -> str | None:
    """What a part was derived from, as its writer noted it."""
    return entries.get(_FROM + part)


def notes(sources: Mapping[str, str]) -> dict[str, str]:
    """Manifest entries that say what parts were derived from."""
    return {_FROM + part: source for part, source in sources.items()}


def switch(spark: SparkSession, path: str, number: int, entries: dict) -> None:
    """Rename a manifest into place. This is the moment a commit happens."""
    folder = f"{path}/{_MANIFESTS}"
    draft = f"{folder}/.draft-{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(entries, sort_keys=True))
    fs, target, jvm = filesystem(spark, f"{folder}/{number:08d}.json")
    draft = jvm.org.apache.hadoop.fs.Path(draft)
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer took commit {number} of {path}")


def kept_entries(spark: SparkSession, path: str, keep: int) -> dict[tuple[int, str], str]:
    """(commit, name) -> folder, of the newest ``keep`` manifests."""
    return {
        (n, name): folder
        for n in _numbers(spark, path)[-keep:]
        for name, folder in _read_manifest(spark, path, n).items()
    }


def drop_manifests(spark: SparkSession, path: str, keep: int) -> None:
    """Remove manifests before the newest ``keep``, and drafts."""
    gone = [f"{n:08d}.json" for n in _numbers(spark, path)[:-keep]]
    gone += [name for name in children(spark, f"{path}/{_MANIFESTS}") if name.startswith(".draft-")]
    for name in gone:
        delete(spark, f"{path}/{_MANIFESTS}/{name}")


def newest(spark: SparkSession, path: str, keep: int) -> list[dict]:
    """The content of the newest ``keep`` manifests."""
    return [_read_manifest(spark, path, n) for n in _numbers(spark, path)[-keep:]]


def tidy(spark: SparkSession, path: str, keep: int = KEPT_COMMITS) -> None:
    """Remove manifests before the last ``keep`` and files that no kept manifest names.

    Run by the writer after its commit. Files of cut-off commits go as well.
    """
    named = {(name, batch) for (_, name), batch in kept_entries(spark, path, keep).items()}
    drop_manifests(spark, path, keep)
    drop_unnamed(spark, path, named)


def drop_unnamed(spark: SparkSession, path: str, named: set[tuple[str, str]]) -> None:
    """Remove the parts of batches that are not among ``named`` pairs of part and batch."""
    held = {batch for _, batch in named}
    for batch in children(spark, path):
        if batch.startswith("batch=") and batch not in held:
            delete(spark, f"{path}/{batch}")
        elif batch.startswith("batch="):
            for part in children(spark, f"{path}/{batch}"):
                if _is_part(part) and (part, batch) not in named:
                    delete(spark, f"{path}/{batch}/{part}")


def folder_name(month: datetime.date | None) -> str:
    return _NO_MONTH if month is None else f"month={month}"


def in_months(day: Column, months: Sequence) -> Column:
    """Whether a day lies in one of the months, where None is the month of rows without a day."""
    known = [month for month in months if month is not None]
    found = F.coalesce(F.trunc(day, "month").isin(known), F.lit(False)) if known else F.lit(False)
    return found | day.isNull() if len(known) < len(months) else found


def read(
    spark: SparkSession,
    path: str,
    schema: StructType,
    months: Sequence | None = None,
    entries: dict[str, str] | None = None,
    by: StructField = MONTH,
) -> DataFrame:
    """The table at its newest commit (or as ``entries`` say), with its ``month``; or the given months of it."""
    if entries is None:
        entries = manifest(spark, path)[1]
    wanted = None if months is None else {folder_name(month) for month in months}
    folders = [
        f"{path}/{batch}/{month}"
        for month, batch in sorted(entries.items())
        if _is_part(month) and (wanted is None or month in wanted)
    ]
    if not folders:
        return spark.createDataFrame([], StructType(schema.fields + [by]))
    stored = StructType(schema.fields + [_BATCH, by])
    reader = spark.read.schema(stored).option("basePath", path)
    return reader.parquet(*folders).drop("batch")


def months_in(entries: dict[str, str]) -> list[datetime.date | None]:
    """The months of a table, in order; None, for rows without a day, comes first."""
    found = [name.removeprefix("month=") for name in entries if name.startswith("month=")]
    days = sorted(datetime.date.fromisoformat(text) for text in found if not text.startswith("__"))
    return ([None] if _NO_MONTH in entries else []) + days


def runs(
    spark: SparkSession, path: str, months: Sequence, entries: Mapping[str, str], at_most: int | None = None
) -> list[list]:
    """``months`` in their order, cut into runs that a table stores ``at_most`` bytes of (or a single month).

    What a job over one run shuffles lies on the disks by itself, so a long table needs no more than a short one.
    """
    at_most = RUN_BYTES if at_most is None else at_most
    found, held = [], 0
    for month in months:
        name = folder_name(month)
        stored = size(spark, f"{path}/{entries[name]}/{name}") if name in entries else 0
        if found and held + stored <= at_most:
            found[-1].append(month)
            held += stored
        else:
            found.append([month])
            held = stored
    return found


def write_batch(
    df: DataFrame,
    path: str,
    sort_by: Sequence[str],
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> str:
    """Write rows by month into a new batch folder, which nothing reads yet.

    ``watch``: see :func:`daygrain.sources.tables.write_version`.
    """
    batch = new_batch(df.sparkSession, path)
    df = df if "month" in df.columns else df.withColumn("month", F.trunc("date", "month"))
    rows = declared.conformed(df, path)
    by = rows.hint("rebalance", "month").sortWithinPartitions("month", *sort_by)
    watch(by).write.options(**COMPRESSED).partitionBy("month").parquet(f"{path}/{batch}")
    declared.require_sound(df.sparkSession, path, f"{path}/{batch}", rows.schema)
    return batch


def write_run(df: DataFrame, path: str, run: str) -> str:
    """Write the rows of one run of a log into a new batch folder, which nothing reads yet."""
    batch = new_batch(df.sparkSession, path)
    rows = declared.conformed(df, path)
    # An empty run is a run as well: its folder replaces what an earlier attempt logged.
    rows.write.options(**COMPRESSED).parquet(f"{path}/{batch}/run={run}")
    declared.require_sound(df.sparkSession, path, f"{path}/{batch}/run={run}", rows.schema)
    return batch


def write(df: DataFrame, path: str, sort_by: Sequence[str] = ("city", "date")) -> int:
    """Replace the months that ``df`` holds by its rows, as one commit."""
    return commit(df.sparkSession, path, write_batch(df, path, sort_by))
