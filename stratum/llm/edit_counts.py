"""Token counts that follow edits: a segment tree of pre-token runs per document.

A document's text is cut into leaves of some hundred code points at places where a pre-token starts
whatever the text around: before a space that a non-space follows. A leaf holds the number of its
code points and tokens, the nodes above hold sums. An edit is found by walking down the
code-point sums; the leaves it touches, back to a cut that the edit leaves in place and on to the next
cut behind it, are encoded again, and the sums on their paths are updated. All other leaves
are never looked at, and the count is the one of the whole new text.

What is kept per document is one row: the leaves' numbers, about a hundredth of the text.

Defined results: null texts are empty; positions beyond the text count as its end, negative ones as 0,
removed stretches end with the text; edits apply in their order, each to the text that the last
one left. Rows with equal id and equal text share a tree and get the same result each; documents
without an edit keep their count. Edits without a document have no effect.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored, text_or_empty
from .words import Codes, default_tokenizer

LEAF = 400
CUT = regex.compile(r" (?=\S)")


def cuts(text: str) -> list[int]:
    """Starts of the leaves of a text: 0 and safe places at least ``LEAF`` apart."""
    places, at = [0], LEAF
    while (found := CUT.search(text, at)) is not None:
        places.append(found.start())
        at = found.start() + LEAF
    return places


class Tree:
    """Sums of (code points, tokens) over leaves, as two heaps in arrays."""

    def __init__(self, leaves: np.ndarray):
        self.rebuild(leaves)

    def rebuild(self, leaves: np.ndarray) -> None:
        self.size = 1
        while self.size < max(1, len(leaves)):
            self.size *= 2
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)
        self.sums[self.size : self.size + len(leaves)] = leaves
        level = self.size
        while level > 1:
            own = self.sums[level : 2 * level]
            self.sums[level // 2 : level] = own[0::2] + own[1::2]
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a code point, or the last one that holds any, and where it starts."""
        node, start = 1, 0
        char = min(char, max(0, self.chars - 1))
        while node < self.size:
            node *= 2
            left = int(self.sums[node, 0])
            if char - start >= left:
                start += left
                node += 1
        return node - self.size, start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def dump(self) -> bytes:
        leaves = self.sums[self.size :]
        return leaves[leaves[:, 0] > 0].astype("<u4").tobytes()

    @staticmethod
    def load(data: bytes) -> Tree:
        return Tree(np.frombuffer(data, dtype="<u4").reshape(-1, 2).astype(np.int64))


def build(text: str, codes: Codes) -> Tree:
    places = [*cuts(text), len(text)]
    leaves = [(b - a, codes.count(text[a:b])) for a, b in zip(places, places[1:])]
    return Tree(np.array(leaves, dtype=np.int64).reshape(-1, 2))


def apply_edit(text: str, tree: Tree, position: int, removed: int, inserted: str, codes: Codes) -> tuple[str, int]:
    """The new text, and how many of its code points were encoded again; ``tree`` is updated."""
    low = min(max(0, position), len(text))
    high = min(low + max(0, removed), len(text))
    # The cut before must keep its space and the character after it.
    leaf, start = tree.leaf_at(max(0, low - 2))
    end_leaf, end = leaf, start + int(tree.sums[leaf + tree.size, 0])
    while end < high or (end < len(text) and end_leaf == leaf and end < low):
        end_leaf += 1
        end += int(tree.sums[end_leaf + tree.size, 0])
    region = text[start:low] + inserted + text[high:end]
    for k in range(leaf + 1, end_leaf + 1):
        tree.set(k, 0, 0)
    tree.set(leaf, len(region), codes.count(region))
    text = text[:low] + inserted + text[high:]
    if len(region) > 8 * LEAF:
        places = cuts(region)
        if len(places) > 1:
            # A region grown large is cut into leaves of its own.
            bounds = [*places, len(region)]
            parts = [(b - a, codes.count(region[a:b])) for a, b in zip(bounds, bounds[1:])]
            old = tree.sums[tree.size :]
            merged = np.concatenate([old[:leaf], np.array(parts, dtype=np.int64), old[leaf + 1 :]])
            tree.rebuild(merged[merged[:, 0] > 0])
    return text, len(region)


def _builder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(path)
        for batch in batches:
            made = [build(text.as_py(), codes).dump() for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["id", "mark", "leaves"])

    return run


def _editor(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("tokens_before", "tokens_after", "chars_after", "chars_encoded")}
            for text, leaves, edits in zip(*(batch.column(name) for name in ("text", "leaves", "edits"))):
                body, tree = text.as_py(), Tree.load(leaves.as_py())
                out["tokens_before"].append(tree.tokens)
                encoded = 0
                for edit in edits.as_py() or ():
                    body, again = apply_edit(body, tree, edit["position"] or 0, edit["removed"] or 0, edit["inserted"] or "", codes)
                    encoded += again
                out["tokens_after"].append(tree.tokens)
                out["chars_after"].append(len(body))
                out["chars_encoded"].append(encoded)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(v, pa.int64()) for v in out.values())], names=["id", *out])

    return run


def build_trees(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row (id, mark, leaves) per distinct id and text; ``mark`` is a hash of the text."""
    body = text_or_empty(text)
    source = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    made = source.mapInArrow(_builder(tokenizer or default_tokenizer()), "id long, mark long, leaves binary")
    return made.dropDuplicates(["id", "mark"])


def count_after_edits(
    docs: DataFrame, trees: DataFrame, edits: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, tokens_before, tokens_after, chars_after, chars_encoded.

    ``edits``: (id, step, position, removed, inserted). Texts are shuffled once, to meet their trees.
    """
    lists = edits.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("step", "position", "removed", "inserted"))).alias("edits"))
    body = text_or_empty(text)
    source = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    state = stored(trees.join(lists, "id", "left"), "edit-trees")
    # A null id meets its trees too.
    met = source.withColumn("join_id", F.coalesce("id", F.lit(-1))).join(
        state.withColumn("join_id", F.coalesce("id", F.lit(-1))).withColumnRenamed("id", "tree_id"), ["join_id", "mark"]
    ).filter(F.col("id").eqNullSafe(F.col("tree_id"))).select("id", "text", "leaves", "edits")
    schema = "id long, tokens_before long, tokens_after long, chars_after long, chars_encoded long"
    return met.mapInArrow(_editor(tokenizer or default_tokenizer()), schema)
