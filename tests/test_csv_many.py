"""Many CSV files at once: how they are parsed, written and put in their places."""

from __future__ import annotations

import itertools
import os

import pytest

from stratum import files, ingest_dataset
from stratum.plans.ingest import read_csv_tables
from stratum.plans.spec import Dataset
from stratum.sources.delimited import _by_width


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


@pytest.mark.parametrize("kind", ["disk", "store"])
def test_tables_take_their_places_in_bulk(spark, tmp_path, monkeypatch, kind):
    """Blank and replaced ones too; on a disk without calls of Spark's client for a table."""
    there = f"{tmp_path}"
    if kind == "store":
        spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.csvbulk.link./in", f"file://{tmp_path}")
        there = "viewfs://csvbulk/in"
    calls = []
    for name in ("move", "copy"):
        monkeypatch.setattr(files, name, lambda *args, name=name, call=getattr(files, name): (calls.append(name), call(*args)))
    (tmp_path / "in" / "d").mkdir(parents=True)

    def put(k: int, text: str, stamp: int) -> None:
        path = tmp_path / "in" / "d" / f"m {k}=%25é.csv"
        path.write_text(text, "utf-8")
        os.utime(path, (stamp, stamp))

    for k in range(30):
        put(k, "a,b\n" if k % 10 == 9 else f"a,b\n{k},x\n{k},y\n", 1_700_000_000)
    made = Dataset("", "bulk", f"{there}/in", f"{there}/out", "**/*.csv", state=f"{there}/state", format="csv")
    numbers = itertools.count()
    monkeypatch.setattr("stratum.plans.ingest.shared_dir", lambda spark, label: f"{there}/scratch-{next(numbers)}")

    def run() -> dict:
        return {r.status: r.n_files for r in ingest_dataset(spark, made).collect()}

    def table(k: int) -> list:
        return sorted(map(tuple, spark.read.parquet(f"{there}/out/d/m {k}=%25é.parquet").collect()))

    assert run() == {"processed": 27, "empty": 3}
    assert [table(k) for k in (0, 9, 28)] == [[(0, "x"), (0, "y")], [], [(28, "x"), (28, "y")]]
    put(0, "a,b\n", 1_800_000_000)
    put(9, "a,b\n7,z\n", 1_800_000_000)
    assert run() == {"processed": 1, "empty": 1, "skipped": 28}
    assert [table(k) for k in (0, 9, 28)] == [[], [(7, "z")], [(28, "x"), (28, "y")]]
    assert read_csv_tables(spark, made, "a bigint, b string").count() == 26 * 2 + 1
    assert kind == "store" or not calls


def test_rows_are_parsed_by_their_own_width():
    assert _by_width({1: ["a"], 2: ["b"], 3: ["c"], 40: ["d"]}) == {2: ["a", "b"], 3: ["c"], 40: ["d"]}
    assert _by_width({width: [str(width)] for width in range(1, 19)}) == {
        16: [str(width) for width in range(1, 17)], 32: ["17", "18"]}


def test_many_small_files_need_few_tasks(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(1200):
        (source / f"{k}.csv").write_text(f"a,b\n{k},x\n" if k % 2 else f"a\n{k}\n")
    made = Dataset("", "few", str(source), str(tmp_path / "out"), "*.csv", state=str(tmp_path / "state"), format="csv")
    since = jobs(spark)
    ingest_dataset(spark, made)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(stage) for job in range(since, jobs(spark)) for stage in tracker.getJobInfo(job).stageIds]
    # Looking the paths up is 32 tasks each time; no other stage has one for every few files.
    assert max(stage.numTasks for stage in stages if stage) <= 32
    tables = read_csv_tables(spark, made, "a bigint, b string")
    assert tables.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert {(r.a, r.b, r.file_key) for r in tables.collect()} == {(k, "x" if k % 2 else None, str(k)) for k in range(1200)}
