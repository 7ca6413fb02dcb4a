"""SimHash links against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm import simhash
from stratum.llm.components import connected_components


def plain_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(values, radius):
    """Component number of each value over all pairs within the radius."""
    values = np.array(values, dtype=np.uint64)
    root = np.arange(len(values))
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius):
            a, b = root[i], root[j]
            if a != b:
                root[root == max(a, b)] = min(a, b)
    return root.tolist()


def test_components_equal_all_pairs(spark):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = [0, 0, (1 << 64) - 1]
    for centre in centres.tolist():
        for _ in range(int(rng.integers(1, 30))):
            flips = rng.choice(64, size=int(rng.integers(0, 7)), replace=False)
            values.append(centre ^ sum(1 << int(k) for k in flips))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    prints = spark.createDataFrame(list(enumerate(signed)), "id long, fingerprint long")
    edges = simhash.linked_fingerprints(prints, 4)
    classes = {row["node"]: row["component"] for row in connected_components(edges).collect()}
    mine = [classes.get(v, v) for v in signed]
    want = components(values, 4)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_links_are_near(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    values = [base, base ^ 0b1111, base ^ 0b11111, base ^ (0b1111 << 20)]
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    classes = {r["node"]: r["component"] for r in connected_components(simhash.linked_fingerprints(prints, 4)).collect()}
    # base ~ +4 bits, +4 bits ~ +5 bits, base ~ the other four bits: one class.
    assert len(set(classes.values())) == 1 and len(classes) == 4
    far = spark.createDataFrame([(base,), (base ^ 0b11111,)], "fingerprint long")
    assert connected_components(simhash.linked_fingerprints(far, 4)).count() == 0


@pytest.mark.parametrize("width", [4, 5])
def test_texts_and_edges(spark, width):
    long = " ".join(f"w{i % 701}" for i in range(70_000))
    texts = [None, "", " \t\n", "One", "one", "a b c", "A  B\tC", "a b c d e", "x y z w v u", long, long + " end", "é É", "tail\x0bword"]
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint int")
    rows = {r["doc_id"]: r for r in simhash.near_duplicate_components(docs, width=width).select(
        "doc_id", simhash.hex_of("fingerprint").alias("hex"), "component_id").collect()}
    want = [plain_fingerprint(t, width) for t in texts]
    assert [rows[i]["hex"] for i in range(len(texts))] == [f"{v:016x}" for v in want]
    assert [rows[i]["component_id"] for i in range(len(texts))] == components(want, 4)


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t u")], "doc_id long, text string")
    rows = simhash.near_duplicate_components(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(5, 5), (5, 5), (None, 5), (None, None)], key=str)
    assert simhash.near_duplicate_components(docs.limit(0)).count() == 0


def test_gap_code_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 4):
        keys = np.sort(rng.integers(0, 1 << 38, 5000, dtype=np.uint64))
        if width == 1:
            keys = np.sort(rng.integers(0, 1 << 20, 5000, dtype=np.uint64))
        keys[:3] = 0
        assert np.array_equal(simhash.decode(simhash.encode(keys, width), width), keys)


def test_fixed_values_of_the_hash(spark):
    """Spark's xxhash64 is the same function, which ties the fingerprints to a second implementation."""
    row = spark.range(1).select(F.xxhash64(F.lit("the cat sat on")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"the cat sat on", 42)


def jaccard(a, b):
    sets = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited(rng, count, start=0):
    """Long texts, each with a copy in which some words are replaced: similarities from about 0.6 to 0.95."""
    rows = []
    for k in range(count):
        words = [f"w{i}" for i in rng.integers(0, 5000, 300)]
        copy = list(words)
        for place in range(5, 290, 290 // (1 + k % 16)):
            copy[place] = f"new{k}x{place}"
        rows += [(start + 2 * k, " ".join(words)), (start + 2 * k + 1, " ".join(copy))]
    return rows


def test_similar_pairs_are_verified_exactly(spark):
    """No pair below the similarity is linked, however near its fingerprints; 0.8 itself counts."""
    rows = edited(np.random.default_rng(5), 64)
    rows += [(900, " ".join(f"u{i}" for i in range(9))), (901, " ".join(f"u{i}" for i in range(8)))]
    text = dict(rows)
    assert jaccard(text[900], text[901]) == 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["component"], r["id"]) for r in simhash.similar_components(docs).collect() if r["id"] != r["component"]}
    want = {(k, k + 1) for k in [*range(0, 128, 2), 900] if jaccard(text[k], text[k + 1]) >= 0.8}
    assert found and found <= want
    below = [k for k in range(0, 128, 2) if 0.6 < jaccard(text[k], text[k + 1]) < 0.8]
    assert len(below) > 10 and not any((k, k + 1) in found for k in below)


def test_similar_links_equal_all_pairs():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, int(rng.integers(1, 40)), replace=False)) for _ in range(150)]
    sets += [np.arange(4, dtype=np.uint64), np.arange(5, dtype=np.uint64)]
    side = np.arange(len(sets)) % 2
    for given in (None, side):
        near = [
            (i, j) for i in range(len(sets)) for j in range(i) if given is None or given[i] != given[j]
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))
        ]
        links = [(max(pair), min(pair)) for pair in simhash.similar_links(sets, 0.8, given)]
        assert len(near) > 5 and set(links) <= set(near) and (151, 150) in near
        root = list(range(len(sets)))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        assert all(root[a] == root[b] for a, b in near)


def test_no_pair_of_a_group_goes_unchecked(spark):
    """Texts of one bag of words have equal finders; the smallest id of them is like none of the others."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(200)]
    orders = [[str(w) for w in rng.permutation(words)] for _ in range(6)]
    rows = [(1, " ".join(orders[0]))]
    for k, order in enumerate(orders[1:]):
        swapped = [*order[:100], order[101], order[100], *order[102:]]
        rows += [(10 * k + 10, " ".join(order)), (10 * k + 11, " ".join(swapped))]
    assert len({tuple(simhash.signature(t.encode().split(), np.zeros(0, dtype=np.uint64))[: simhash.FINDERS]) for _, t in rows}) == 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["component"], r["id"]) for r in simhash.similar_components(docs).collect() if r["id"] != r["component"]}
    assert found == {(k, k + 1) for k in range(10, 60, 10)}


def test_large_groups_are_dealt_into_tiles(spark, monkeypatch):
    """Chunks of two members find what one chunk finds."""
    rows = edited(np.random.default_rng(9), 12)
    sets = {k: simhash.shingle_set(simhash.words_of(t), 5) for k, t in rows}
    source = spark.createDataFrame(rows, "id long, text string")
    nodes = spark.createDataFrame([(simhash.mark_of(s), k, len(s)) for k, s in sets.items()], "mark string, least long, size long")
    groups = nodes.selectExpr("1L as key", "mark")
    monkeypatch.setattr(simhash, "CHUNK_SETS", 2)
    links = {tuple(sorted(r)) for r in simhash.verified_links(source, nodes, groups, 5, 0.8).collect()}
    text = dict(rows)
    assert links == {(k, k + 1) for k in range(0, 24, 2) if jaccard(text[k], text[k + 1]) >= 0.8} and links
