"""Counters over a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def batch_summary(manifest: DataFrame) -> DataFrame:
    """Files per dataset and status, with rows where the manifest counts them."""
    measures = [F.count(F.lit(1)).alias("n_files")]
    if "n_rows" in manifest.columns:
        measures.append(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return manifest.groupBy("dataset", "status").agg(*measures)
