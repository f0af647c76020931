"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from daygrain.sources.files import COMPRESSED, delete

#: What a stage asks of its session.
STAGE_SETTINGS = {
    # Shuffle files go with the job that wrote them; else they stay until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(
    app_name: str = "daygrain",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    memory: str | None = None,
) -> SparkSession:
    """A session with the settings the library relies on.

    Leave ``master`` and ``shuffle_partitions`` unset on a cluster: the master
    comes from spark-submit, and adaptive execution sizes the partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false"
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a folder of its own,
    because executors on other machines could not read it. The path's folder is
    deleted when the driver ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="daygrain-")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/daygrain/{uuid.uuid4().hex}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{base.rstrip('/')}/daygrain/{folder.getName()}/{label}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back: computed once, and the same ever after."""
    return _stored(df, scratch_path(df.sparkSession, label))


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.options(**COMPRESSED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as :func:`written` gives it, for the length of a block: its files go at the end."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _stored(df, path)
    finally:
        delete(df.sparkSession, path)
