"""Landing files made from tables, for the registered queries and the benchmark."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import files
from .session import session_conf, shared_dir

# Seconds spent on preparing landing files, per query: kept apart from the operator's own time.
PREPARATION: dict[str, float] = {}
_PREPARED: dict[tuple[str, str, str], str] = {}


def prepared(spark: SparkSession, name: str, sf_dir: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` has filled; made once per application and input directory."""
    known = (spark.sparkContext.applicationId, name, sf_dir)
    if known not in _PREPARED:
        folder, start = shared_dir(spark, f"landing-{name}"), time.perf_counter()
        write(folder)
        PREPARATION[name] = time.perf_counter() - start
        _PREPARED[known] = folder
    return _PREPARED[known]


def write_documents(records: DataFrame, folder: str, by: str | None = None, per_file: int = 1000) -> None:
    """JSON files that hold a list of at most ``per_file`` records each.

    ``records`` has the JSON text of a record in ``record``. Rows are cut into files by their
    position, so no value of the data decides how large a file gets. ``by`` names a column
    whose values become sub-folders.
    """
    keys = [by] if by else []
    slot = F.floor(F.monotonically_increasing_id() / per_file).alias("slot")
    cut = records.select("record", *keys, slot)
    text = F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]"))
    documents = cut.groupBy(*keys, "slot").agg(text.alias("value")).drop("slot")
    writer = documents.write.option("maxRecordsPerFile", 1)
    (writer.partitionBy(by) if by else writer).text(folder)


# Of texts that go to Python at once.
BATCH_BYTES = "4m"


def _write_files(texts: DataFrame, folder: str) -> None:
    """One file per row, below a folder that every task finds on its machine's disk: ``file``, the path there, and ``value``, the content.

    Spark's writer sets the permissions of each file by a process of its own, the check sum's too, where Hadoop's native
    library is missing (17 ms a file here), and the driver renames all of them.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        made = set()
        for batch in batches:
            for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True):
                path = f"{folder}/{file}"
                above, name = path.rsplit("/", 1)
                if above not in made:
                    os.makedirs(above, exist_ok=True)
                    made.add(above)
                # Another attempt at the task may be at the same file; the check sum of a former one would not fit.
                new = f"{above}/.{name}.{task.taskAttemptId()}"
                with open(new, "wb") as out:
                    out.write(value or b"")
                    out.write(b"\n")
                if os.path.exists(f"{above}/.{name}.crc"):
                    os.remove(f"{above}/.{name}.crc")
                os.replace(new, path)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    content = texts.select("file", F.col("value").cast("binary").alias("value"))
    with session_conf(texts.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES):
        content.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()


def write_named(texts: DataFrame, folder: str) -> None:
    """Files with given names: ``file`` is the path below ``folder``, ``value`` the whole content.

    On a disk the tasks write them. In other stores Spark picks its files' names itself, so each one is renamed; the loop
    has one step per file.
    """
    spark = texts.sparkSession
    mounted = files.mounted_path(spark, folder)
    if mounted:
        _write_files(texts, mounted)
        return
    made = shared_dir(spark, "named")
    texts.write.option("maxRecordsPerFile", 1).partitionBy("file").text(made)
    for row in spark.read.text(made, wholetext=True).select("file", "_metadata.file_path").toLocalIterator():
        files.move_uri(spark, row.file_path, f"{folder}/{row.file}")
    files.delete(spark, made)


def as_list(records: DataFrame) -> DataFrame:
    """``file, value``: the records of each ``file`` as one JSON list."""
    text = F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]"))
    return records.groupBy("file").agg(text.alias("value"))


# Files of one folder.
MANY_FILES = 10_000


def write_single_records(records: DataFrame, folder: str) -> None:
    """One JSON file per record, with an object as its root."""
    mounted = files.mounted_path(records.sparkSession, folder)
    if not mounted:
        records.select("record").write.option("maxRecordsPerFile", 1).text(folder)
        return
    files.make_folder(records.sparkSession, folder)
    # Names go with the rows, so whichever task writes a file writes the same.
    place = F.monotonically_increasing_id()
    name = F.format_string("%d/%d.json", F.floor(place / MANY_FILES), place)
    texts = records.select(name.alias("file"), F.col("record").alias("value"))
    _write_files(texts.repartition(2 * texts.sparkSession.sparkContext.defaultParallelism), mounted)


def as_record(*fields) -> "F.Column":
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record")
