"""What several operators share: written intermediate tables, text expressions, table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.session import scratch_path

# The letters that count as letters of either case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a scratch folder when the driver ends."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and survives lost executors. The folder goes when the
    driver ends, since results read from it until then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone; null counts as empty."""
    text = text_or_empty(text)
    only_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
