"""Parquet scans. Pruning and pushdown are Spark's; nothing is read before an action."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def parquet_glob(spark: SparkSession, pattern: str, schema=None) -> DataFrame:
    """All files of a glob as one frame.

    Files of one dataset may differ in columns. Pass the dataset's schema where it is known;
    otherwise the schemas of all files are merged, because the default would keep the
    columns of one file only.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return reader.parquet(pattern)
