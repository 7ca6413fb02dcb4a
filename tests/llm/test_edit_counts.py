"""Counts after edits against the count of the whole new text."""

from __future__ import annotations

import random

import pytest

from stratum.llm import edit_counts as E
from stratum.llm.words import Codes, default_tokenizer


@pytest.fixture(scope="module")
def codes():
    return Codes(default_tokenizer())


def words(rng, n):
    return "".join(rng.choice(["alpha", "b", "don't", "  ", "\n", " ", ".", "né", "7", "東"]) + rng.choice([" ", " ", "", "\n "]) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_random_edits(codes, seed):
    rng = random.Random(seed)
    text = words(rng, rng.choice([0, 1, 30, 700]))
    tree = E.build(text, codes)
    assert tree.tokens == codes.count(text) and tree.chars == len(text)
    for _ in range(25):
        at, gone, new = rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 5, 900]), words(rng, rng.choice([0, 1, 3, 1500 if seed % 5 == 0 else 4]))
        low = min(max(0, at), len(text))
        want = text[:low] + new + text[min(low + gone, len(text)):]
        text, _ = E.apply_edit(text, tree, at, gone, new, codes)
        assert text == want and tree.chars == len(text) and tree.tokens == codes.count(text)
        tree = E.Tree.load(tree.dump()) if rng.random() < 0.3 else tree


def test_one_edit_is_local(codes):
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = E.build(text, codes)
    _, again = E.apply_edit(text, tree, 60_000, 3, "xyz", codes)
    assert again < 4 * E.LEAF


def test_rows(spark, codes):
    texts = [(1, "one two three"), (1, "one two three"), (1, "other text"), (2, None), (None, "no id"), (3, "kept")]
    docs = spark.createDataFrame([(*row, 0) for row in texts], "doc_id long, text string, leaves int")
    edits = spark.createDataFrame([(1, 0, 3, 0, " and"), (1, 1, 0, 4, None), (2, 0, 9, 9, "new"), (9, 0, 0, 0, "x")], "id long, step int, position int, removed int, inserted string")
    got = E.count_after_edits(docs, E.build_trees(docs), edits).collect()
    want = []
    for doc_id, text in texts:
        before = after = text or ""
        if doc_id == 1:
            after = (before[:3] + " and" + before[3:])[4:]
        if doc_id == 2:
            after = "new"
        want.append((doc_id, codes.count(before), codes.count(after), len(after)))
    assert sorted([tuple(r)[:4] for r in got], key=str) == sorted(want, key=str)
    assert E.count_after_edits(docs.limit(0), E.build_trees(docs.limit(0)), edits).count() == 0
