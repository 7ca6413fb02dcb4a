"""Every query of the folder as registered, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratum.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = {"op1": "pages", "op4": "pages", "op11": None, "op13": None, "op5": None, "op8": None, "op9": None}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def n_rows(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_runs_over_its_whole_table(spark, name):
    found = queries.QUERIES[name](spark, SF)
    rows = found.collect()
    table = TABLES.get(name.split("_")[0], "documents")
    if table:
        assert len(rows) == n_rows(spark, table)
    if "doc_id" in found.columns and name.split("_")[0] in ("op2", "op3", "op7", "op8", "op10"):
        assert len({r["doc_id"] for r in rows}) == n_rows(spark, "documents")


def test_shards_hold_one_law(spark):
    rows = queries.QUERIES["op3_ring_shards"](spark, SF).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= 1.2 * sum(sizes.values()) / 16 + max(r["size"] for r in rows)


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else frozenset([tuple(words)]) if words else frozenset()


def longest_common(item, words):
    row = [0] * (len(item) + 1)
    for word in words:
        before = 0
        for k, own in enumerate(item, 1):
            before, row[k] = row[k], before + 1 if own == word else max(row[k], row[k - 1])
    return row[-1]


def hostile(documents):
    """The table with a clashing column, null and blank texts, copies and a repeated row."""
    extra = documents.limit(3)
    made = documents.unionByName(extra).unionByName(extra.withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("text", F.concat(F.lit(" "), "text")))
    made = made.unionByName(extra.withColumn("doc_id", F.col("doc_id") + 2_000_000).withColumn("text", F.lit(None).cast("string")))
    return made.withColumn("score", F.lit(1)).withColumn("row", F.lit("r"))


def test_pipeline_stages_against_brute_force(spark, documents, tmp_path):
    docs, kept = hostile(documents), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        kept[name] = (docs.collect(), spark.read.parquet(str(tmp_path / name)).collect())
        docs = spark.read.parquet(str(tmp_path / name))

    before, after = kept["exact dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", r["text"] or "")].append(r)
    want = sorted(min(rows, key=lambda r: (-len(r["text"] or ""), r["doc_id"]))["doc_id"] for rows in groups.values())
    assert sorted(r["doc_id"] for r in after) == want

    before, after = kept["near-dedup"]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    root = {i: i for i in sets}
    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and sets[j] and root[i] != root[j]:
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                    old, new = max(root[i], root[j]), min(root[i], root[j])
                    root = {k: new if r == old else r for k, r in root.items()}
    assert sorted(r["doc_id"] for r in after) == [i for i in ids if root[i] == i]

    before, after = kept["decontamination"]
    words = {r["doc_id"]: re.findall(r"\w+", (r["text"] or "").lower()) for r in before}
    items = [re.findall(r"\w+", (r["text"] or "").lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in after}
    for i, own in words.items():
        whole = any(" ".join(item) in " ".join(own) for item in items if item)
        if whole:
            assert i not in left
        elif i not in left:
            assert max(longest_common(item, own) / len(item) for item in items if item) >= 0.7


def test_pipeline_runs_on_an_empty_table(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_packs_all_that_is_left(spark):
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    by_doc = pieces.sort_values(["doc_id", "start"]).groupby("doc_id")
    assert (by_doc["length"].sum() == by_doc["doc_tokens"].first()).all()
    assert pieces.groupby("sequence_id")["length"].sum().max() <= 1024
    assert np.array_equal(pieces.groupby("doc_id")["start"].min().unique(), [0])
