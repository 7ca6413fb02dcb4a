"""The prefix trie against a brute-force trie, and the contraction against sums along paths."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stratum.llm import contraction, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos long, a long, digest string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """The contract of op11 by dictionaries of tuples."""
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said = ((role or ""), (text or ""))
            digest = hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), digest, said))
    own = {conv: [said for _, _, said in sorted(turns)] for conv, turns in own.items()}
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20 if conv >= 0 else -(abs(conv) % 20))
        built[conv] = own.get(base, [])[:h] + turns[h:]
    members: dict[tuple, list] = {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for node, convs in members.items():
        below = [other for other in members if other[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:-1] == x for y in members)]
        saved = sum((len(members[x]) - 1) * (len(WORDS.findall(x[-1][1])) if x else 0) for x in below)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(node)))
        kids = sum(1 for x in members if len(x) == len(node) + 1 and x[:-1] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), kids, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes_of(spark, rows):
    df = spark.createDataFrame([(c, t, r, x, 9, 9, "d") for c, t, r, x in rows], SCHEMA)
    conv = F.col("conv")
    turns = prefix_trie.positions(prefix_trie.turn_rows(df))
    convs, rebuilt = prefix_trie.spliced(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, most=3)
    return [tuple(r) for r in prefix_trie.trie(convs, rebuilt).drop("a", "b").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def test_trie_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for conv in [*rng.sample(range(-45, 130), 60), 0, 20, 40]:
        for turn in range(rng.choice([1, 1, 2, 3, 5])):
            rows.append((conv, rng.choice([None, turn, turn]), rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", None, "", " ", "x\ty z"])))
    rows += [(None, 1, "user", "lost"), (7, 3, "user", "a"), (7, 3, "user", "a")]
    assert ordered(nodes_of(spark, rows)) == ordered(brute(rows))


def test_one_conversation_with_a_third_of_all_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_TURNS", 16)
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    rows = [(40, turn, "user", f"w{turn % 5} x") for turn in range(120)] + [(41 + k, 0, "user", "only") for k in range(30)]
    rows += [(100 + k, turn, "user", "same words") for k in range(20) for turn in range(3)] + [(5, 0, "user", "long " * 50_000)]
    assert ordered(nodes_of(spark, rows)) == ordered(brute(rows))


def test_empty_table(spark):
    assert nodes_of(spark, []) == []


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_contraction_sums_subtrees(spark, shape):
    rng = random.Random(7)
    parent = {0: None}
    for k in range(1, 300):
        parent[k] = {"chain": k - 1, "star": 0, "random": rng.choice([k - 1, k - 1, rng.randrange(k)])}[shape]
    weight = {k: rng.randrange(10) for k in parent}
    total = dict(weight)
    for k in sorted(parent, reverse=True):
        if parent[k] is not None:
            total[parent[k]] += total[k]
    kids = [sum(1 for p in parent.values() if p == k) for k in parent]
    rows = [(k, -k, p, None if p is None else -p, kids[k], weight[k]) for k, p in parent.items()]
    df = spark.createDataFrame(rows, "a long, b long, pa long, pb long, n_children long, w long")
    found = contraction.subtree_totals(df, ["w"]).collect()
    assert {r["a"]: r["total_w"] for r in found} == total and len(found) == len(total)
    assert contraction.subtree_totals(df.limit(0), ["w"]).count() == 0
