"""Small files and folders, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: How data files are written.
COMPRESSED = {"compression": "zstd"}


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location, jvm


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, location, _ = filesystem(spark, path)
    if not fs.exists(location):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(location))


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path; none where there is nothing."""
    fs, location, _ = filesystem(spark, path)
    return fs.getContentSummary(location).getLength() if fs.exists(location) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, location, _ = filesystem(spark, path)
    fs.delete(location, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, location, jvm = filesystem(spark, path)
    stream = fs.open(location)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; one that exists is not touched."""
    fs, location, _ = filesystem(spark, path)
    out = fs.create(location, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
