"""One file's names or another run never stop or lose what is not theirs."""

from __future__ import annotations

import threading
import time
from dataclasses import replace

import pytest

from stratum import ingest_dataset, read_bronze
from stratum.plans import commits, ingest as ingest_module
from stratum.plans.manifest import read_manifest
from stratum.plans.spec import BY_BATCH, BY_FILE

LAYOUTS = [BY_FILE, BY_BATCH]


def statuses(landing) -> dict[str, str]:
    return {r.file_key: r.status for r in read_manifest(landing.spark, landing.dataset).collect()}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_only_files_with_clashing_names_are_errors(make_landing, layout):
    landing = make_landing(layout=layout)
    for i in range(3):
        landing.put(f"{i}.json", [{"id": i, "a": {"b": i}}])
    landing.put("case.json", [{"Id": 7}])
    landing.put("flat.json", [{"id": 8, "a_b": 9}])
    landing.put("null.json", [{"id": 9, "a_b": None}])
    landing.put("own.json", {"file_key": "x", "id": 10})
    assert landing.run() == {"processed": 4, "error": 3}
    assert {key for key, status in statuses(landing).items() if status == "error"} == {"case", "flat", "own"}
    assert landing.rows("id", "a_b") == [(0, 0), (1, 1), (2, 2), (9, None)]
    landing.put("flat.json", [{"id": 8, "a": {"b": 9}}])
    landing.run()
    assert (8, 9) in landing.rows("id", "a_b")


def test_stored_names_win_over_more_files(make_landing):
    landing = make_landing(layout=BY_BATCH)
    landing.put("first.json", [{"id": 1}])
    landing.run()
    for i in range(3):
        landing.put(f"{i}.json", [{"ID": i}])
    assert landing.run() == {"error": 3, "skipped": 1}
    assert landing.rows("id") == [(1,)]


def both(landing, monkeypatch, step: str, second, **options):
    """Run the dataset; while its first run stands before ``step``, another run goes from start to end."""
    plain = getattr(ingest_module, step)
    inside, result = threading.Event(), {}

    def stopped(run, *args, **kwargs):
        if threading.current_thread().name == "first" and not inside.is_set():
            inside.set()
            second()
        return plain(run, *args, **kwargs)

    monkeypatch.setattr(ingest_module, step, stopped)

    def first():
        try:
            result["summary"] = {r.status: r.n_files for r in ingest_dataset(landing.spark, landing.dataset, **options).collect()}
        except BaseException as failure:  # noqa: BLE001
            result["failure"] = failure

    thread = threading.Thread(target=first, name="first")
    thread.start()
    thread.join(300)
    assert "failure" not in result, result
    return result["summary"]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_two_runs_at_once_lose_and_double_nothing(make_landing, monkeypatch, layout):
    landing = make_landing(layout=layout)
    for i in range(4):
        landing.put(f"{i}.json", [{"id": i}])
    seen = {}

    def second():
        landing.put("late.json", [{"id": 100}])
        other = landing.spark.newSession()
        seen["second"] = {r.status: r.n_files for r in ingest_dataset(other, landing.dataset).collect()}

    # Between the first run's rows and its manifest entry the other reads all, and clears up what it finds left behind.
    assert both(landing, monkeypatch, "_commit_batch", second) == {"processed": 4}
    assert seen["second"] == {"processed": 5}
    assert landing.rows("id") == [(0,), (1,), (100,), (2,), (3,)]
    assert landing.run() == {"skipped": 5}
    assert landing.rows("id") == [(0,), (1,), (100,), (2,), (3,)]


def test_both_runs_change_the_schema(make_landing, monkeypatch):
    landing = make_landing(layout=BY_BATCH)
    landing.put("old.json", [{"id": 1, "v": 1}])
    landing.run()
    landing.put("a.json", [{"id": 2, "v": 2, "left": "x"}])
    pattern = replace(landing.dataset, pattern="b*.json")

    def second():
        landing.put("b.json", [{"id": 3, "v": 2.5, "right": "y"}])
        ingest_dataset(landing.spark.newSession(), pattern).collect()

    both(landing, monkeypatch, "_commit_batch", second)
    assert landing.rows("id", "v", "left", "right") == [(1, 1.0, None, None), (2, 2.0, "x", None), (3, 2.5, None, "y")]


def test_a_dead_run_blocks_for_a_lease_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "LEASE_SECONDS", 1.0)
    state = str(tmp_path / "state")
    dead, alive = commits.RunLog(spark, state, 1), commits.RunLog(spark, state, 2)
    from stratum import files

    files.write_text(spark, f"{state}/runs/1", "1")
    assert files.create_new(spark, f"{state}/commits/{1:012d}", "1")
    assert not files.create_new(spark, f"{state}/commits/{1:012d}", "2")
    began = time.time()
    with alive.lease(), alive.commit(), alive.commit():
        assert time.time() - began > 0.5
        assert dead.live_runs() == [2]
    assert alive.live_runs() == []


def test_rows_opened_before_a_compaction_stay_readable(make_landing):
    landing = make_landing(layout=BY_BATCH)
    landing.dataset = replace(landing.dataset, grace=600.0)
    for i in range(4):
        landing.put(f"{i}.json", [{"id": i}])
    landing.run()
    version = read_manifest(landing.spark, landing.dataset).agg({"run": "max"}).first()[0]
    opened = read_bronze(landing.spark, landing.dataset)
    for i in range(3):
        landing.put(f"{i}.json", [{"id": 10 + i}])
    landing.run()
    assert sorted(r.id for r in opened.collect()) == [0, 1, 2, 3]
    assert sorted(r.id for r in read_bronze(landing.spark, landing.dataset, version=version).collect()) == [0, 1, 2, 3]
    assert sorted(r.id for r in landing.table().collect()) == [3, 10, 11, 12]
    landing.dataset = replace(landing.dataset, grace=0.0)
    landing.put("4.json", [{"id": 4}])
    landing.run()
    assert sorted(r.id for r in landing.table().collect()) == [3, 4, 10, 11, 12]
    assert landing.spark.read.parquet(str(landing.root / "table")).count() == 5


@pytest.mark.parametrize("pattern", ["*.json", "*/*.json", "**/*.json"])
def test_names_that_spark_hides_have_a_status(make_landing, pattern):
    landing = make_landing(layout=BY_BATCH, pattern=pattern)
    folder = "" if pattern == "*.json" else "sub/"
    for name in ("a", "_x", ".y"):
        landing.put(f"{folder}{name}.json", [{"id": 1}])
    landing.put(f"{folder}_SUCCESS", "")
    assert landing.run() == {"processed": 1, "error": 2}
    assert {key for key, status in statuses(landing).items() if status == "error"} == {f"{folder}_x", f"{folder}.y"}
    assert landing.run() == {"skipped": 1, "error": 2}
