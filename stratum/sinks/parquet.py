"""Parquet writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import files
from ..session import session_conf


def write_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_partitions(
    df: DataFrame, path: str, column: str, compression: str = "snappy", gather: bool = False
) -> None:
    """Replace the partitions that ``df`` has rows for and keep all others.

    Without ``gather`` every task writes what it holds, with no shuffle: right for a scan of
    landing files, whose rows are already together. With ``gather`` rows are first brought
    together per partition value; the rebalance splits a value that is too large for one
    task, so one hot value does not become one huge write.
    """
    if gather:
        df = df.hint("rebalance", column)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(column)
        .parquet(path)
    )


# Spark's client for disks adds a check sum file to each file and, where Hadoop's native library is missing, sets the permissions of each
# of both and of each folder by a process of its own, some 8 ms each here. The plain client does neither; Parquet's pages have check sums.
PLAIN_DISK = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_new_partitions(df: DataFrame, path: str, column: str, compression: str = "snappy") -> None:
    """Write a folder nobody reads yet, each partition by one task, which also puts it in its place.

    Names follow from the task's number, so a repeated task writes over what a failed one has left.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .options(**PLAIN_DISK)
        .option("compression", compression)
        .partitionBy(column)
        .parquet(path)
    )


def write_pending(df: DataFrame, pending: str, column: str) -> None:
    """Write a replacement beside the table; its success marker says that it is complete."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(pending)


def finish_replacement(spark: SparkSession, path: str, column: str, pending: str) -> None:
    """Carry a completely written replacement over to the table; drop an incomplete one."""
    if files.exists(spark, f"{pending}/_SUCCESS") and files.has_partitions(spark, pending):
        # Partition values stay text, as written: type guessing would turn 007 into 7.
        with session_conf(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false"):
            write_partitions(spark.read.parquet(pending), path, column)
    files.delete(spark, pending)


def drop_partitions(df: DataFrame) -> int:
    """Delete the partition folders that hold the rows of ``df``, a filtered table scan."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
    folders = [row.folder for row in df.select(folder.alias("folder")).distinct().toLocalIterator()]
    for uri in folders:
        files.delete_uri(df.sparkSession, uri)
    return len(folders)
