"""Which files have to be read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NEW, STALE, FRESH, SOURCE_MISSING = "new", "stale", "fresh", "source_missing"


def is_source_newer(src_mtime: Column, out_mtime: Column) -> Column:
    """No output yet, or a source strictly younger than the output."""
    return out_mtime.isNull() | (src_mtime > out_mtime)


def freshness_plan(sources: DataFrame, outputs: DataFrame, overwrite: bool = False) -> DataFrame:
    """Action per file from ``sources(file_key, src_mtime, ..)`` and ``outputs(file_key, out_mtime, ..)``."""
    src, out = F.col("src_mtime"), F.col("out_mtime")
    action = (
        F.when(src.isNull(), SOURCE_MISSING)
        .when(out.isNull(), NEW)
        .when(is_source_newer(src, out) | F.lit(overwrite), STALE)
        .otherwise(FRESH)
    )
    return sources.join(outputs, "file_key", "full_outer").withColumn("action", action)
