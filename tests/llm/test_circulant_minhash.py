"""Circulant MinHash classes against all pairs, and the properties of its permutations."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stratum.llm import circulant_minhash as cm

SCHEMA = "doc_id long, text string, id string, size int, component string, key int, node int"


def brute(texts, width, percent):
    """(n, component) per row by all pairs on sets of word tuples; ids may repeat or be null."""
    sets = []
    for _, text in texts:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(zip(*[words[k:] for k in range(width)])) if len(words) >= width else frozenset([tuple(words)]) if words else frozenset())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    out = []
    for i, (id_, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if root[j] == root[i] and texts[j][0] is not None]
        component = (min(ids) if ids else None) if sets[i] else id_
        out.append((id_, len(sets[i]), component, id_ == component))
    return sorted(out, key=repr)


def found(spark, texts, width=2, percent=80):
    df = spark.createDataFrame([(i, t, "x", 1, "c", 1, 1) for i, t in texts], SCHEMA)
    return sorted((tuple(r) for r in cm.near_duplicates(df, width, percent).collect()), key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
    return " ".join(words)


def test_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cm, "CHUNK_SETS", 4)
    rng = random.Random(11)
    texts = [(k, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 5, 40, 90])))) for k in range(60)]
    for base in range(12):
        words = [f"b{base}_{rng.randrange(60)}" for _ in range(80)]
        texts += [(1000 + base * 20 + k, edited(rng, words, rng.choice([0, 1, 3, 5, 9]))) for k in range(12)]
    texts += [(None, "one two three"), (None, "ONE two  three"), (7, "one two three"), (7, "one two three"), (90, None), (91, ""), (92, " \t"), (93, "solo"), (94, "Solo")]
    texts += [(None, "no id at all"), (95, " ".join(f"l{k}" for k in range(30_000))), (96, " ".join(f"l{k}" for k in range(29_000)))]
    assert found(spark, texts) == brute(texts, 2, 80)


def test_a_chain_inside_one_key(spark, monkeypatch):
    """Each text is near the next only; a hot group in which stars cannot find all links."""
    monkeypatch.setattr(cm, "CHUNK_SETS", 3)
    words = [f"c{k}" for k in range(400)]
    texts = [(k, " ".join(words[6 * k : 6 * k + 100])) for k in range(40)]
    assert found(spark, texts) == brute(texts, 2, 80)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_second_permutation_is_one():
    values = np.arange(1 << 20, dtype=np.uint32)
    assert len(np.unique(cm.permuted(values.copy()))) == len(values)


@pytest.mark.parametrize("size", [5, 40, 1000])
def test_signature_estimates_jaccard(size):
    rng = np.random.default_rng(2)
    shared, missing = size - size // 5, size // 5
    agree = []
    for _ in range(60):
        values = np.unique(rng.integers(0, 1 << 63, shared + 2 * missing, dtype=np.uint64) * np.uint64(2))
        one, other = values[: shared + missing], np.concatenate([values[:shared], values[shared + missing :]])
        agree.append((cm.signature(one) == cm.signature(other)).mean())
    want = shared / (shared + 2 * missing)
    assert abs(np.mean(agree) - want) < 0.04


def test_a_member_of_many_keys_is_one_row(spark, monkeypatch):
    """A group of near copies with a stray: what may still be linked is looked at once a text, not once a key."""
    rng = random.Random(4)
    words = [f"b{rng.randrange(300)}" for _ in range(200)]
    texts = [(k, edited(rng, words, rng.choice([2, 4, 8, 14, 16, 18]))) for k in range(60)]
    seen = []
    plain = cm._open_members
    monkeypatch.setattr(cm, "_open_members", lambda members, reach: seen.append(members.groupBy("key").count().collect()) or plain(members, reach))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted((tuple(r) for r in cm.near_duplicates(df, 2, 80).collect()), key=repr) == brute(texts, 2, 80)
    assert 0 < len(seen[0]) < len(texts) and max(row["count"] for row in seen[0]) < len(texts)
