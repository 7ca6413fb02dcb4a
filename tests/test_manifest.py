"""The manifest stays as small as its files, and tells of a run while it lasts."""

from __future__ import annotations

import pytest

from stratum import files
from stratum.plans import ingest as ingest_module, manifest
from stratum.plans.manifest import read_manifest
from stratum.plans.spec import BY_BATCH, BY_FILE


@pytest.mark.parametrize("layout", [BY_FILE, BY_BATCH])
def test_a_long_manifest_is_checkpointed(make_landing, monkeypatch, layout):
    plain = manifest.checkpoint_manifest
    made = []

    def early(spark, dataset, kept, run, most=4):
        made.append(plain(spark, dataset, kept, run, most))
        return made[-1]

    monkeypatch.setattr(ingest_module, "checkpoint_manifest", early)
    landing = make_landing(layout=layout)
    for i in range(3):
        landing.put(f"{i}.json", [{"id": i}])
    landing.put("bad.json", "[{")
    landing.run()
    for turn in range(1, 7):
        landing.put("0.json", [{"id": 100 + turn}])
        assert landing.run() == {"processed": 1, "skipped": 2, "error": 1}
        assert landing.rows("id") == sorted([(1,), (2,), (100 + turn,)], key=repr)
    assert made.count(True) >= 2
    entries = read_manifest(landing.spark, landing.dataset)
    assert entries.count() < 16 and {r.file_key for r in entries.collect()} == {"0", "1", "2", "bad"}
    folders = [p.rsplit("/", 1)[-1] for p in files.children(landing.spark, landing.dataset.state)]
    assert sum(name == "manifest" or name.startswith("manifest-1") for name in folders) <= 2
    landing.put("2.json", [])
    assert landing.run() == {"empty": 1, "skipped": 2, "error": 1}
    assert landing.rows("id") == [(1,), (106,)]


def test_progress_is_told_during_the_run(make_landing):
    landing = make_landing(layout=BY_BATCH)
    for i in range(6):
        landing.put(f"{i}.json", [{"id": i}] * 2)
    landing.put("bad.json", "[{")
    told = []

    def watch(counts):
        asked = ingest_module.run_progress(landing.spark, landing.dataset).collect()
        told.append((counts, sum(r.n_files for r in asked), sum(r.n_rows for r in asked)))

    landing.run(max_files=2, on_progress=watch)
    assert len(told) > 1 and told[0][1] < 7 and told[-1][0] == {"processed": 6, "error": 1} and told[-1][1:] == (7, 12)
    assert [files_ for _, files_, _ in told] == sorted(files_ for _, files_, _ in told)
    assert ingest_module.run_progress(landing.spark, landing.dataset).count() == 0
