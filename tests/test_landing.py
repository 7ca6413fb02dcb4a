"""Landing files made from tables, and reading many of them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from stratum import files
from stratum.landing import as_record, write_named, write_single_records
from stratum.sources.documents import infer_documents, read_documents


@pytest.fixture(params=["disk", "store"])
def place(request, spark, tmp_path, monkeypatch):
    """A folder on a disk, or the same in a store that tasks do not see as a disk; its path there and here."""
    if request.param == "disk":
        return str(tmp_path), tmp_path
    mount = f"t{abs(hash(str(tmp_path)))}"
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mount}.link./in", f"file://{tmp_path}")
    monkeypatch.setattr("stratum.landing.shared_dir", lambda spark, label: f"viewfs://{mount}/in/shared-{label}")
    return f"viewfs://{mount}/in", tmp_path


def landed(folder):
    return sorted(path for path in folder.rglob("*") if path.is_file() and path.name[0] not in "._")


def test_single_records(spark, place):
    there, here = place
    rows = spark.range(40).select(as_record(F.col("id"), F.when(F.col("id") != 3, F.concat(F.lit("ñ "), "id")).alias("name")))
    write_single_records(rows, f"{there}/one")
    texts = [path.read_text("utf-8") for path in landed(here / "one")]
    assert sorted(json.loads(text)["id"] for text in texts) == list(range(40))
    assert all(text.startswith("{") and text.endswith("}\n") for text in texts)
    got = {tuple(row) for row in read_documents(spark, f"{there}/one").select("id", "name").collect()}
    assert got == {(k, None if k == 3 else f"ñ {k}") for k in range(40)}


def test_named_files_take_the_place_of_others(spark, place):
    """Also of copies with a check sum beside them."""
    there, here = place
    first = spark.createDataFrame([("a/1.json", "[1]"), ("a/b c=%.json", "[2]"), ("2.json", None)], "file string, value string")
    write_named(first, f"{there}/old")
    assert {path.relative_to(here / "old").as_posix(): path.read_text() for path in landed(here / "old")} == {
        "a/1.json": "[1]\n", "a/b c=%.json": "[2]\n", "2.json": "\n"}
    files.copy(spark, f"{there}/old", f"{there}/new")
    write_named(spark.createDataFrame([("a/1.json", "[11, 12]")], "file string, value string"), f"{there}/new")
    texts = spark.read.option("recursiveFileLookup", True).text(f"{there}/new", wholetext=True)
    assert sorted(row.value for row in texts.collect()) == ["\n", "[11, 12]\n", "[2]\n"]


def tasks(spark, since: int) -> int:
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(stage) for job in range(since, next_job(spark)) for stage in tracker.getJobInfo(job).stageIds]
    return sum(stage.numTasks for stage in stages if stage)


def next_job(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_many_small_documents_need_few_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(1600):
        (folder / f"{k}.json").write_text(f'{{"id":{k}}}')
    since = next_job(spark)
    schema = infer_documents(spark, [str(folder)])
    assert tasks(spark, since) <= 16
    df = read_documents(spark, str(folder), path_column="path")
    assert df.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    got = {(row.id, row.path.rsplit("/", 1)[1]) for row in df.collect()}
    assert got == {(k, f"{k}.json") for k in range(1600)} and schema.names == ["id"]
