"""Layer runs over the known sources."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from .. import files
from ..operators.rows import concat_vertical
from .ingest import ingest_dataset
from .lineups import build_lineups
from .spec import BY_FILE, SOURCES, Dataset, dataset, datasets_of

log = logging.getLogger(__name__)


def _single(path: str, output_dir: str, state_dir: str | None, **settings) -> Dataset:
    folder, _, name = path.rstrip("/").rpartition("/")
    return _batch(folder or ".", output_dir, state_dir, pattern=name, **settings)


def _batch(input_dir: str, output_dir: str, state_dir: str | None, **settings) -> Dataset:
    output = output_dir.rstrip("/")
    name = settings.pop("name", None) or output.rpartition("/")[2]
    return Dataset("", name, input_dir.rstrip("/"), output, state=state_dir or f"{output}_state", **settings)


def ingest_json(
    spark: SparkSession, input_file: str, output_dir: str, state_dir: str | None = None,
    serialize_lists: bool = True, overwrite: bool = False, format: str = "json",
) -> DataFrame:
    """One JSON file to a Parquet table, if it is new or changed. Returns the summary."""
    made = _single(input_file, output_dir, state_dir, serialize_lists=serialize_lists, format=format)
    return ingest_dataset(spark, made, overwrite)


def ingest_json_batch(
    spark: SparkSession, input_dir: str, output_dir: str, state_dir: str | None = None,
    file_pattern: str = "*.json", serialize_lists: bool = True, output_prefix: str = "",
    overwrite: bool = False, layout: str = BY_FILE, format: str = "json",
) -> DataFrame:
    """All JSON files of a directory that match a pattern to one Parquet table."""
    made = _batch(
        input_dir, output_dir, state_dir, pattern=file_pattern, serialize_lists=serialize_lists,
        prefix=output_prefix, layout=layout, format=format,
    )
    return ingest_dataset(spark, made, overwrite)


def ingest_csv(
    spark: SparkSession, input_file: str, output_dir: str, state_dir: str | None = None, overwrite: bool = False
) -> DataFrame:
    return ingest_dataset(spark, _single(input_file, output_dir, state_dir, format="csv"), overwrite)


def ingest_csv_batch(
    spark: SparkSession, input_dir: str, output_dir: str, state_dir: str | None = None,
    file_pattern: str = "*.csv", overwrite: bool = False,
) -> DataFrame:
    """All CSV files of a directory, one table ``<file_key>.parquet`` each."""
    made = _batch(input_dir, output_dir, state_dir, pattern=file_pattern, format="csv")
    return ingest_dataset(spark, made, overwrite)


def ingest_named(spark: SparkSession, base: str, source: str, name: str, overwrite: bool = False, **settings) -> DataFrame:
    """One dataset of a source below ``base``; ``settings`` replace fields of its definition."""
    made = replace(dataset(source, name), **settings) if settings else dataset(source, name)
    return ingest_dataset(spark, made.below(base), overwrite)


def ingest_source(spark: SparkSession, base: str, source: str, overwrite: bool = False) -> DataFrame:
    """All datasets of a source, in the order of their definition."""
    return concat_vertical(*[ingest_dataset(spark, made.below(base), overwrite) for made in datasets_of(source)])


def run_bronze(
    spark: SparkSession, base: str, sources: Iterable[str] | str | None = None,
    overwrite: bool = False, on_error: str = "fail",
) -> dict[str, DataFrame]:
    """Bronze for the given sources, or all. Returns the summary of each source.

    ``on_error``: ``fail`` raises at once, ``stop`` ends after the failing source and raises,
    ``continue`` goes through all sources and only logs.
    """
    if on_error not in ("fail", "stop", "continue"):
        raise ValueError(f"on_error must be fail, stop or continue, not {on_error!r}")
    chosen = [sources] if isinstance(sources, str) else list(sources or SOURCES)
    summaries, failed = {}, {}
    for source in chosen:
        try:
            summaries[source] = ingest_source(spark, base, source, overwrite)
        except Exception as failure:
            if on_error == "fail":
                raise
            log.error("bronze of %s failed: %s", source, failure)
            failed[source] = failure
            if on_error == "stop":
                break
    if failed and on_error == "stop":
        raise RuntimeError(f"bronze failed for {', '.join(failed)}") from next(iter(failed.values()))
    return summaries


def run_silver(spark: SparkSession, base: str, sources: Iterable[str] | str | None = None) -> list[str]:
    """Silver tables of the given sources; only lineups have one. Returns the paths written."""
    chosen = [sources] if isinstance(sources, str) else list(sources or SOURCES)
    written = []
    for source in chosen:
        datasets_of(source)
        if source == "open_data" and files.exists(spark, dataset(source, "lineups").below(base).bronze):
            written.append(build_lineups(spark, base))
        else:
            log.warning("no silver job for %s", source)
    return written


def run_pipeline(
    spark: SparkSession, base: str, bronze: bool = True, silver: bool = False, gold: bool = False,
    source: str | None = None, overwrite: bool = False, on_error: str = "fail",
) -> bool:
    """Run the chosen layers in order over one source, or over all; true, or raises."""
    if source is not None:
        datasets_of(source)
    if bronze:
        run_bronze(spark, base, source, overwrite, on_error)
    if silver:
        run_silver(spark, base, source)
    if gold:
        log.warning("the gold layer has no jobs")
    return True
