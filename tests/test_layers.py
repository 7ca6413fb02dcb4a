"""Dataset jobs and layer runs on a generated landing tree."""

from __future__ import annotations

import json
import logging

import pytest

from stratum import (
    DATASETS, SOURCES, build_lineups, ingest_csv, ingest_json, ingest_json_batch, ingest_named, lineups_by_match,
    read_bronze, run_bronze, run_pipeline, run_silver,
)
from stratum.plans.spec import BY_BATCH, dataset, datasets_of


@pytest.fixture
def tree(tmp_path):
    def put(name: str, content) -> None:
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content), "utf-8")

    team = {"team_id": 7, "team_name": "Añ", "lineup": [{"player": {"id": 1}}]}
    put("open_data/data/competitions.json", [{"competition_id": 2, "season": {"id": 27}}])
    put("open_data/data/matches/2/44.json", [{"match_id": 1}])
    put("open_data/data/matches/11/44.json", [{"match_id": 2}])
    put("open_data/data/lineups/100.json", [team, {**team, "team_id": 8, "team_name": "B"}])
    put("open_data/data/lineups/101.json", [team, team])
    put("open_data/data/lineups/notes.json", [team])
    put("open_data/data/events/100.json", [{"id": "e", "location": [1.0, 2], "pass": {"end": [3]}}])
    put("open_data/data/three-sixty/100.json", [{"event_uuid": "e", "visible_area": [0.5]}])
    put("j1_league/sb-matches/sb_matches.json", [{"match_id": 5}])
    put("j1_league/sb-events/sb_events.json", [{"id": "j"}])
    put("j1_league/hudl-physical/hudl_physical.json", {"player": {"id": 3}})
    put("j1_league/mappings/teams.csv", "a.id,b.id\n1,2\n")
    return tmp_path


def test_whole_run(spark, tree):
    base = str(tree)
    assert run_pipeline(spark, base, bronze=True, silver=True, gold=True) is True

    def bronze(source, name):
        return read_bronze(spark, dataset(source, name).below(base))

    assert bronze("open_data", "competitions").drop("file_key").collect() == [(2, 27)]
    matches = bronze("open_data", "matches").orderBy("match_id").collect()
    assert [tuple(r) for r in matches] == [(1, "matches_2/44"), (2, "matches_11/44")]
    event = bronze("open_data", "events").first()
    assert (event.location, event.pass_end, event.file_key) == ("[1.0, 2]", [3], "events_100")
    assert bronze("open_data", "three-sixty").first().file_key == "events_three_sixty_100"
    assert bronze("j1_league", "physical").first().player_id == 3
    assert bronze("j1_league", "events").first().id == "j"
    assert bronze("j1_league", "matches").first().match_id == 5
    mapping = spark.read.parquet(f"{base}/bronze/j1_league/mappings/teams.parquet")
    assert mapping.columns == ["a_id", "b_id"]

    silver = spark.read.parquet(f"{base}/silver/open_data/lineups/lineups_by_match")
    assert sorted((r.match_id, r.team_id, r.team_name, json.loads(r.lineup)[0]["player"]["id"]) for r in silver.collect()) == [
        (100, 7, "Añ", 1), (100, 8, "B", 1), (101, 7, "Añ", 1),
    ]
    assert {f.suffixes[-2] for f in (tree / "silver").rglob("*.parquet")} == {".zstd"}
    assert {f.suffixes[-2] for f in (tree / "bronze").rglob("part-*.parquet")} == {".snappy"}

    again = run_bronze(spark, base)
    assert all(row.status == "skipped" for summary in again.values() for row in summary.collect())


def test_missing_landing_is_no_failure(spark, tmp_path):
    summaries = run_bronze(spark, str(tmp_path), "open_data")
    assert summaries["open_data"].collect() == []


def test_unknown_source(spark, tmp_path):
    for run in (run_bronze, run_silver):
        with pytest.raises(ValueError, match="unknown source 'x'"):
            run(spark, str(tmp_path), "x")
    with pytest.raises(ValueError, match="unknown source"):
        run_pipeline(spark, str(tmp_path), source="x")


def test_error_policies(spark, tree, caplog):
    base = str(tree)
    (tree / "landing/open_data/data/competitions.json").write_text('[{"a":{"b":1,"b":2}}]')
    with pytest.raises(ValueError, match="share one name"):
        run_bronze(spark, base)
    with pytest.raises(RuntimeError, match="bronze failed for open_data"):
        run_bronze(spark, base, on_error="stop")
    with caplog.at_level(logging.ERROR):
        assert list(run_bronze(spark, base, on_error="continue")) == ["j1_league"]
    assert "open_data" in caplog.text
    with pytest.raises(ValueError, match="on_error"):
        run_bronze(spark, base, on_error="ignore")


def test_silver_needs_lineup_files(spark, tree):
    with pytest.raises(RuntimeError, match="no lineup files"):
        build_lineups(spark, str(tree))


def test_silver_of_plain_files(spark, tmp_path):
    """Files named lineups_<id>.parquet in one folder, in any letter case; other names are ignored."""
    from pyspark.sql import functions as F

    for i, name in enumerate(["lineups_7.parquet", "LINEUPS_8.PARQUET", "lineups_x.parquet", "other_9.parquet"]):
        rows = [(1, "b", f"[{i}]"), (1, "a", f"[{i}]")]
        frame = spark.createDataFrame(rows, "team_id bigint, team_name string, lineup string").coalesce(1)
        frame.write.parquet(str(tmp_path / "parts" / str(i)))
        (tmp_path / "flat").mkdir(exist_ok=True)
        part = next((tmp_path / "parts" / str(i)).glob("part-*.parquet"))
        (tmp_path / "flat" / name).write_bytes(part.read_bytes())
    bronze = spark.read.parquet(str(tmp_path / "flat"))
    got = lineups_by_match(bronze, F.col("_metadata.file_path")).select("match_id", "team_id", "team_name", "lineup")
    assert sorted(map(tuple, got.collect())) == [(7, 1, "a", "[0]"), (8, 1, "a", "[1]")]


def test_single_file_functions(spark, tree):
    landing, out = f"{tree}/landing", f"{tree}/out"
    row = ingest_json(spark, f"{landing}/open_data/data/competitions.json", f"{out}/competitions").first()
    assert (row.dataset, row.status, row.n_files) == ("competitions", "processed", 1)
    assert ingest_csv(spark, f"{landing}/j1_league/mappings/teams.csv", f"{out}/maps").first().status == "processed"
    assert ingest_json(spark, f"{landing}/none.json", f"{out}/none").collect() == []
    batch = ingest_json_batch(spark, f"{landing}/open_data/data/lineups", f"{out}/lineups", output_prefix="l", layout=BY_BATCH)
    assert [(r.status, r.n_files) for r in batch.collect()] == [("processed", 3)]
    assert spark.read.parquet(f"{out}/lineups").select("file_key").distinct().count() == 3


def test_one_named_dataset(spark, tree):
    row = ingest_named(spark, str(tree), "open_data", "events", layout=BY_BATCH).first()
    assert (row.dataset, row.status, row.n_rows) == ("events", "processed", 1)


def test_definitions():
    assert SOURCES == ("open_data", "j1_league")
    assert [d.name for d in datasets_of("open_data")] == ["competitions", "matches", "lineups", "events", "three-sixty"]
    assert [d.name for d in datasets_of("j1_league")] == ["matches", "events", "physical", "mappings"]
    assert len({(d.source, d.name) for d in DATASETS}) == 9
