"""Repeated runs: what is read again, replaced, kept and removed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stratum import ingest_dataset
from stratum import files
from stratum.operators import freshness_plan
from stratum.plans import ingest as ingest_module
from stratum.plans.manifest import load_schema, read_manifest
from stratum.plans.spec import BY_BATCH, BY_FILE

LAYOUTS = [BY_FILE, BY_BATCH]


def stamps(landing) -> dict[str, float]:
    found = landing.root.glob("table/**/*.parquet")
    return {str(p.relative_to(landing.root)): p.stat().st_mtime_ns for p in found}


def test_freshness_actions(spark):
    at = "timestamp'2024-01-01 00:00:{}'"
    sources = spark.sql(
        f"select * from values ('a', {at.format('05')}), ('b', {at.format('05')}), ('c', {at.format('05')}), "
        f"('d', {at.format('05')}) t(file_key, src_mtime)"
    )
    outputs = spark.sql(
        f"select * from values ('a', {at.format('05')}), ('b', {at.format('04')}), ('c', {at.format('06')}), "
        f"('gone', {at.format('01')}) t(file_key, out_mtime)"
    )
    found = {r.file_key: r.action for r in freshness_plan(sources, outputs).collect()}
    assert found == {"a": "fresh", "b": "stale", "c": "fresh", "d": "new", "gone": "source_missing"}
    forced = {r.file_key: r.action for r in freshness_plan(sources, outputs, overwrite=True).collect()}
    assert forced == {"a": "stale", "b": "stale", "c": "stale", "d": "new", "gone": "source_missing"}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_life_of_a_dataset(make_landing, layout):
    landing = make_landing(layout=layout, pattern="*/*.json", prefix="matches")
    landing.put("2/44.json", [{"id": 1}, {"id": 2}])
    landing.put("11/44.json", [{"id": 3}])
    landing.put("11/45.json", [{"id": 4}])
    landing.put("skip.json", [{"id": 99}])
    assert landing.run() == {"processed": 3}
    assert landing.rows("file_key", "id") == [
        ("matches_11/44", 3), ("matches_11/45", 4), ("matches_2/44", 1), ("matches_2/44", 2),
    ]

    before = stamps(landing)
    assert landing.run() == {"skipped": 3}
    assert stamps(landing) == before

    landing.put("11/44.json", [{"id": 30}, {"id": 31}])
    landing.put("3/1.json", [{"id": 5}])
    assert landing.run() == {"processed": 2, "skipped": 2}
    assert [i for (i,) in landing.rows("id")] == [1, 2, 30, 31, 4, 5]
    if layout == BY_FILE:
        after = stamps(landing)
        assert {name for name in before if after.get(name) != before[name]} == {n for n in before if "11%2F44" in n}

    landing.put("2/44.json", '[{"id":1')  # becomes malformed: last good rows stay, retried each run
    landing.put("11/45.json", "[]")  # becomes empty: rows go
    os.remove(landing.root / "in/3/1.json")  # source gone: rows stay
    assert landing.run() == {"error": 1, "empty": 1, "skipped": 1, "source_missing": 1}
    assert [i for (i,) in landing.rows("id")] == [1, 2, 30, 31, 5]
    assert landing.run() == {"error": 1, "skipped": 2, "source_missing": 1}
    assert landing.run(overwrite=True) == {"processed": 1, "empty": 1, "error": 1, "source_missing": 1}
    assert [i for (i,) in landing.rows("id")] == [1, 2, 30, 31, 5]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_crash_before_the_manifest_is_repeated(make_landing, monkeypatch, layout):
    landing = make_landing(layout=layout)
    landing.put("a.json", [{"id": 1}])
    landing.put("b.json", [{"id": 2}])
    landing.run()
    landing.put("a.json", [{"id": 10}])

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "append_manifest", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            landing.run()
    assert landing.run() == {"processed": 1, "skipped": 1}
    assert landing.rows("id") == [(10,), (2,)]
    stored = landing.spark.read.parquet(str(landing.root / "table"))
    assert stored.count() == 2


def test_last_good_rows_outlive_a_crash_and_a_source_broken_after_it(make_landing, monkeypatch):
    landing = make_landing(layout=BY_BATCH)
    landing.put("a.json", [{"id": 1}])
    landing.put("b.json", [{"id": 2}])
    landing.run()
    landing.put("a.json", [{"id": 10}])

    def crash(*_):
        raise RuntimeError("driver lost")

    for step in ("append_manifest", "_compact"):
        with monkeypatch.context() as patch:
            patch.setattr(ingest_module, step, crash)
            with pytest.raises(RuntimeError, match="driver lost"):
                landing.run()
        assert landing.rows("id") == ([(1,), (2,)] if step == "append_manifest" else [(10,), (2,)])
    landing.put("a.json", "[{")
    assert landing.run() == {"error": 1, "skipped": 1}
    assert landing.rows("id") == [(10,), (2,)]


def test_a_source_broken_after_a_crash_keeps_the_version_before(make_landing, monkeypatch):
    landing = make_landing(layout=BY_BATCH)
    landing.put("a.json", [{"id": 1}])
    landing.put("b.json", [{"id": 2}])
    landing.run()
    landing.put("a.json", [{"id": 10}])

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "append_manifest", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            landing.run()
    landing.put("a.json", "[{")
    assert landing.run() == {"error": 1, "skipped": 1}
    assert landing.rows("id") == [(1,), (2,)]


@pytest.mark.parametrize("step", ["append", "delete"])
def test_compaction_outlives_a_crash(make_landing, monkeypatch, step):
    landing = make_landing(layout=BY_BATCH)
    for i in range(3):
        landing.put(f"{i}.json", [{"id": i}])
    landing.run()
    landing.put("0.json", [{"id": 10}])
    append, calls = ingest_module.append_manifest, []

    def second_append_fails(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost in the middle")
        append(*args)

    def crash(*_):
        raise RuntimeError("lost in the middle")

    with monkeypatch.context() as patch:
        if step == "append":
            patch.setattr(ingest_module, "append_manifest", second_append_fails)
        else:
            compact = ingest_module._compact

            def compact_until_delete(run):
                patch.setattr(ingest_module, "_drop_dead_batches", crash)
                compact(run)

            patch.setattr(ingest_module, "_compact", compact_until_delete)
        with pytest.raises(RuntimeError, match="lost in the middle"):
            landing.run()
    assert landing.rows("id") == [(1,), (10,), (2,)]
    landing.put("3.json", [{"id": 3}])
    assert landing.run() == {"processed": 1, "skipped": 3}
    assert landing.rows("id") == [(1,), (10,), (2,), (3,)]
    assert landing.spark.read.parquet(str(landing.root / "table")).count() == 4


def test_few_replaced_rows_leave_their_batch_untouched(make_landing):
    landing = make_landing(layout=BY_BATCH)
    for i in range(10):
        landing.put(f"{i}.json", [{"id": i}])
    landing.run()
    before = stamps(landing)
    landing.put("4.json", [{"id": 40}])
    assert landing.run() == {"processed": 1, "skipped": 9}
    after = stamps(landing)
    assert before.items() <= after.items()
    assert landing.rows("id") == sorted(((i if i != 4 else 40,) for i in range(10)), key=repr)
    assert landing.run() == {"skipped": 10}


def test_type_change_outlives_a_crash(landing, monkeypatch):
    landing.put("a.json", [{"v": 1}])
    landing.run()
    landing.put("b.json", [{"v": 2.5}])

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "finish_replacement", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            landing.run()
    assert load_schema(landing.spark, landing.dataset)[0]["v"].dataType.simpleString() == "double"
    landing.run()
    assert landing.rows("v") == [(1.0,), (2.5,)]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_type_change_converts_what_is_stored(make_landing, layout):
    landing = make_landing(layout=layout)
    landing.put("007.json", [{"v": 1, "t": 5}])
    landing.run()
    landing.put("b.json", [{"v": 2.5, "t": "x"}])
    landing.run()
    assert landing.columns() == {"v": "double", "t": "string"}
    assert landing.rows("file_key", "v", "t") == [("007", 1.0, "5"), ("b", 2.5, "x")]


def test_missing_landing_folder(spark, landing):
    from dataclasses import replace

    gone = replace(landing.dataset, landing=str(landing.root / "nowhere"))
    assert ingest_dataset(spark, gone).collect() == []
    single = replace(landing.dataset, pattern="one.json")
    assert ingest_dataset(spark, single).collect() == []


def test_many_batches_cover_every_file_once(make_landing):
    landing = make_landing(layout=BY_BATCH)
    for i in range(9):
        landing.put(f"{i}.json", [{"id": i}])
    assert landing.run(max_files=2) == {"processed": 9}
    assert landing.rows("id") == [(i,) for i in range(9)]
    assert len(list((landing.root / "table").glob("ingest_batch=*"))) > 1


def test_row_counts_in_the_summary(spark, landing):
    landing.put("a.json", [{"id": 1}, {"id": 2}])
    landing.put("b.json", {"id": 3})
    row = ingest_dataset(spark, landing.dataset).first()
    assert (row.dataset, row.status, row.n_files, row.n_rows) == ("table", "processed", 2, 3)
    counts = read_manifest(spark, landing.dataset).select("file_key", "n_rows").orderBy(F.col("file_key")).collect()
    assert [tuple(r) for r in counts] == [("a", 2), ("b", 1)]
