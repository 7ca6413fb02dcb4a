"""Incremental ingestion of nested JSON and CSV files into Parquet tables, on Spark."""

from .plans.ingest import ConcurrentRunError, SchemaDriftError, ingest_dataset, read_bronze, read_csv_tables, run_progress
from .plans.layers import (
    ingest_csv, ingest_csv_batch, ingest_json, ingest_json_batch, ingest_named, ingest_source, run_bronze, run_pipeline,
    run_silver,
)
from .plans.lineups import build_lineups, lineups_by_match
from .plans.spec import DATASETS, SOURCES, Dataset

__all__ = [
    "ConcurrentRunError", "DATASETS", "SOURCES", "Dataset", "SchemaDriftError", "build_lineups", "ingest_csv", "ingest_csv_batch",
    "ingest_dataset", "ingest_json", "ingest_json_batch", "ingest_named", "ingest_source", "lineups_by_match",
    "read_bronze", "read_csv_tables", "run_bronze", "run_pipeline", "run_progress", "run_silver",
]
