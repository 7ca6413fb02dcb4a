"""State of a dataset: what was read, when, and the schema so far."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from .. import files
from ..sinks.parquet import write_table
from .spec import Dataset

MANIFEST_SCHEMA = (
    "file_key string, path string, src_mtime timestamp, length bigint, status string, n_rows bigint, "
    "ingest_batch bigint, run bigint, recorded_at timestamp"
)
CURRENT_SCHEMA = "file_key string, out_mtime timestamp, ingest_batch bigint, run bigint"

# ``moved``: the file was not read, its rows were copied to another batch.
PROCESSED, EMPTY, ERROR, MOVED = "processed", "empty", "error", "moved"


# Appends to the manifest after which it is written anew, and what it is then called.
MOST_APPENDS = 200
POINTER = "manifest-current"


def _manifest_path(spark: SparkSession, dataset: Dataset) -> str:
    """The folder that is the manifest now: the first one, or the one that a checkpoint made."""
    name = files.read_text(spark, f"{dataset.state}/{POINTER}") if files.exists(spark, f"{dataset.state}/{POINTER}") else ""
    return f"{dataset.state}/{name or 'manifest'}"


def read_manifest(spark: SparkSession, dataset: Dataset) -> DataFrame:
    path = _manifest_path(spark, dataset)
    if not files.exists(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def append_manifest(entries: DataFrame, dataset: Dataset) -> None:
    columns = [field.name for field in T.StructType.fromDDL(MANIFEST_SCHEMA).fields]
    stamped = entries.withColumn("recorded_at", F.current_timestamp()).select(*columns)
    stamped.write.mode("append").parquet(_manifest_path(entries.sparkSession, dataset))


def checkpoint_manifest(spark: SparkSession, dataset: Dataset, kept_batches: set[int], run: int, most: int = MOST_APPENDS) -> bool:
    """Write what still matters of a long manifest to a new folder and make that the manifest; only inside a commit.

    What matters: of each file the last entry and the last successful one, where rows of it lie in a batch that still exists, and all of ``run``.
    So the size is that of the files and not that of the history. The switch is one small file; until it is there the old
    folder counts. The one before the last goes, so that whoever has opened the last can read on.
    """
    path = _manifest_path(spark, dataset)
    if not files.exists(spark, path) or len(files.children(spark, path)) <= most:
        return False
    entries = read_manifest(spark, dataset)
    order = F.struct("run", "recorded_at")
    done = F.col("status").isin(PROCESSED, EMPTY, MOVED)
    last = entries.groupBy("file_key").agg(F.max(order).alias("any"), F.max(F.when(done, order)).alias("good"))
    held = F.coalesce(F.col("ingest_batch").isin(*kept_batches), F.lit(False)) if kept_batches else F.lit(False)
    matters = entries.withColumn("at", order).join(last, "file_key").where(
        (F.col("at") == F.col("any")) | F.coalesce(F.col("at") == F.col("good"), F.lit(False)) | held | (F.col("run") == run))
    name = f"manifest-{run}"
    write_table(matters.select(*entries.columns), f"{dataset.state}/{name}")
    current = path.rsplit("/", 1)[-1]
    files.write_text(spark, f"{dataset.state}/{POINTER}", name)
    for old in files.children(spark, dataset.state):
        folder = old.rsplit("/", 1)[-1]
        if folder == "manifest" or folder.startswith("manifest-") and folder != POINTER:
            if folder not in (name, current):
                files.delete(spark, old)
    return True


def _outputs(spark: SparkSession, dataset: Dataset, version: int | None = None) -> DataFrame:
    entries = read_manifest(spark, dataset).where(F.col("status").isin(PROCESSED, EMPTY, MOVED))
    return entries if version is None else entries.where(F.col("run") <= version)


def current_entries(spark: SparkSession, dataset: Dataset, version: int | None = None) -> DataFrame:
    """Per file the manifest's last entry that tells where its rows are, in the manifest's columns.

    ``version`` is a run's id: what that run and those before it had noted.
    """
    entries = _outputs(spark, dataset, version)
    others = [name for name in entries.columns if name != "file_key"]
    last = F.max_by(F.struct(*others), F.col("run")).alias("last")
    return entries.groupBy("file_key").agg(last).select("file_key", "last.*")


def current_outputs(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """Last successful read per file: ``file_key, out_mtime, ingest_batch, run``.

    ``out_mtime`` is the age of the source version that the output holds, so an edit during a
    run is still seen by the next one. A failed read leaves the last good one in force.
    """
    current = current_entries(spark, dataset)
    return current.select("file_key", F.col("src_mtime").alias("out_mtime"), "ingest_batch", "run")


def replaced_outputs(spark: SparkSession, dataset: Dataset, version: int | None = None) -> DataFrame:
    """Where rows were that a later read replaced or a compaction moved: ``file_key, ingest_batch``."""
    entries = _outputs(spark, dataset, version).where(F.col("ingest_batch").isNotNull()).select("file_key", "ingest_batch")
    current = current_entries(spark, dataset, version).select("file_key", "ingest_batch")
    return entries.join(current, ["file_key", "ingest_batch"], "left_anti")


def batch_counts(spark: SparkSession, dataset: Dataset, version: int | None = None) -> list[Row]:
    """Per batch how many files ever had rows there and how many still have, and when the last one lost them (null if none did).

    One row per batch reaches the driver, as its folder does in Spark's file index.
    """
    held = _outputs(spark, dataset, version).where(F.col("ingest_batch").isNotNull() & (F.col("n_rows") > 0)).select("file_key", "ingest_batch").distinct()
    current = current_entries(spark, dataset, version).select("file_key", F.col("ingest_batch").alias("now"), "n_rows", "recorded_at")
    still = F.col("now").eqNullSafe(F.col("ingest_batch")) & (F.col("n_rows") > 0)
    counts = held.join(current, "file_key").groupBy("ingest_batch").agg(
        F.count(F.lit(1)).alias("n_files"), F.count(F.when(still, 1)).alias("n_current"), F.max(F.when(~still, F.col("recorded_at"))).alias("left_at"))
    return list(counts.toLocalIterator())


def load_schema(spark: SparkSession, dataset: Dataset) -> tuple[T.StructType | None, set[str], int | None]:
    """The dataset's record schema, the fields of it that never had a value, and its version."""
    path = f"{dataset.state}/schema"
    if files.exists(spark, f"{path}/_SUCCESS"):
        last = spark.read.schema("version bigint, body string").json(path).orderBy(F.desc("version")).first()
        if last:
            body = json.loads(last.body)
            return T.StructType.fromJson(body["fields"]), set(body["unseen"]), last.version
    return (T.StructType.fromDDL(dataset.schema) if dataset.schema else None), set(), None


def save_schema(spark: SparkSession, dataset: Dataset, version: int, schema: T.StructType, unseen: set[str]) -> None:
    body = json.dumps({"fields": schema.jsonValue(), "unseen": sorted(unseen)})
    row = spark.createDataFrame([(version, body)], "version bigint, body string")
    row.write.mode("append").json(f"{dataset.state}/schema")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and read it back: a cut in the plan that outlives executors."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
