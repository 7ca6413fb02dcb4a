"""Benchmark decontamination by latent semantic retrieval.

Words of the benchmark are the terms. Documents are written once as term numbers and cut into passages
of ``PASSAGE`` words, half overlapping. A passage's TF-IDF vector (document frequencies over all
documents) is projected on the leading right singular vectors of the passage matrix and on what these leave of the
block's items, so no item loses its direction; items whose cosine in that space is at least ``cosine`` are
candidates, if the passage's words in the item make up at least ``shared_weight`` of the weight of the item's heaviest
``PASSAGE`` words in a row. Two passages hold any such words together, so of a whole copy one passage has half of that. For every candidate the longest common subsequence
of the item and the passage with what surrounds it decides: a share of ``verbatim`` of the item's words,
or of ``paraphrase`` if the answer is found as well. The answer is the ``answer`` column where the
benchmark has one, else the item's last sentence.

The singular vectors are those of all passages of all documents, and of the benchmark, weighted as much as the rest. One pass
counts, in integers, how often two terms share a passage; the counts lie in slices of ``SLICE`` cells, summed in a stream per
slice, so no task holds more than ``CELLS`` of them and no two runs differ. A randomised subspace iteration then multiplies the
slices with the present basis, a Spark job per round; tasks send ``terms x rank`` numbers. The benchmark is a
stated query set, taken in blocks of ``ITEMS_AT_ONCE`` items, so what tasks get has a bound.

Defined results: null and empty texts hold no passage and no item; items without a word match nothing;
repeated rows and repeated items match alike; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import gives_back, no_rows, small_batches, stored

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?]+")
PASSAGE = 64
HALF = PASSAGE // 2
ITEMS_AT_ONCE = 256
ROWS_AT_ONCE = 2_048
OVERSAMPLE = 16
# Pair counts of a pass over the documents, of a slice, words of a portion, and pairs after which a task sends what it has.
CELLS, SLICE, PORTION, SEND_PAIRS = 1 << 23, 1 << 15, 1 << 15, 1 << 30
SLICES_AT_ONCE = 64
# Ranges of terms in which the tasks' products are summed.
RANGES = 8
OTHER = 0


# For texts of the first 256 characters: what is no word is a space.
SPACED = bytes(code if WORD.match(chr(code)) else 32 for code in range(256))


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def coder(terms: dict[str, int], width: int) -> Callable[[str | None], bytes]:
    """A function that gives the terms of a text's words (``OTHER`` if they have none) as little-endian numbers of ``width`` bytes."""
    look = {word: term.to_bytes(width, "little") for word, term in terms.items()}
    # The same for words as bytes, which texts of the first 256 characters are cut into several times as fast.
    narrow = {word.encode("latin-1"): code for word, code in look.items() if max(map(ord, word)) < 256}
    other = OTHER.to_bytes(width, "little")

    def code(text: str | None) -> bytes:
        try:
            words = (text or "").lower().encode("latin-1").translate(SPACED).split()
        except UnicodeEncodeError:
            return b"".join(map(look.get, words_of(text), repeat(other)))
        return b"".join(map(narrow.get, words, repeat(other)))

    return code


@dataclass
class Items:
    """A block of the benchmark: term numbers (0 is any other word), and per item its terms and its answer's."""

    ids: list[int]
    terms: dict[str, int]
    words: list[np.ndarray]
    answers: list[np.ndarray]


def read_items(rows: list, has_answer: bool) -> Items:
    items = Items([], {}, [], [])
    for row in rows:
        words = words_of(row["text"])
        if not words:
            continue
        sentences = [s for s in SENTENCE.split(row["text"]) if words_of(s)]
        answer = words_of(row["answer"]) if has_answer and row["answer"] else words_of(sentences[-1])
        for word in [*words, *answer]:
            items.terms.setdefault(word, len(items.terms) + 1)
        items.ids.append(row["item_id"])
        items.words.append(np.array([items.terms[word] for word in words], dtype=np.int64))
        items.answers.append(np.array([items.terms[word] for word in answer], dtype=np.int64))
    return items


def _encoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(shared.value.terms, np.dtype(_kind(shared.value)).itemsize)
        for batch in batches:
            coded = [code(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.binary())], names=["doc_id", "words"])

    return gives_back(run)


def _kind(items: Items) -> str:
    return "<u2" if len(items.terms) < 65_535 else "<u4"


def slice_rows(size: int) -> int:
    """Terms of a slice of pair counts, of ``size`` cells a term."""
    return max(1, SLICE // size)


def _count_pairs(kind: str, size: int, low: int, high: int):
    """Per slice of the terms from ``low`` to ``high``: how many documents hold each, and what ``pair_counts`` says."""
    rows = slice_rows(size)
    # A pair is counted at its lesser term: terms from low on have a row each, from the term itself to the last one.
    room = size - np.arange(low, high)
    row = np.zeros(size, dtype=np.int64)
    row[low:high] = np.cumsum(room) - room - np.arange(low, high)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(room.sum(), dtype=np.int32)
        own, held = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        pairs = 0

        def add(docs: list[np.ndarray]) -> int:
            lengths = np.array([len(words) for words in docs])
            halves = -(-lengths // HALF)
            half = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // HALF
            every = np.concatenate(docs)
            known = np.flatnonzero(every)
            word, half = every[known].astype(np.int32), half[known]
            owner = np.repeat(np.arange(len(docs)), lengths)[known]
            # A half passage inside a document lies in two passages, the first and the last in one; two beside each other share one.
            inside = (half > 0) & (half < halves[owner] - 1)
            number = (half + (np.cumsum(halves + 1) - halves)[owner]).astype(np.int32)
            own[:] += np.bincount(word, minlength=size) + np.bincount(word[inside], minlength=size)
            # How many words follow a word in its passages, and in its own half passage where that lies in two; those with most followers first.
            place = np.arange(len(word))
            follow = np.searchsorted(number, number + 1, "right") - place - 1
            both = np.where(inside, np.searchsorted(number, number, "right") - place - 1, 0)
            left = np.argsort(-follow, kind="stable")
            first, both, done = word[left], both[left], 0
            for lag, n in enumerate(np.searchsorted(-follow[left], -np.arange(1, PASSAGE), "right").tolist(), 1):
                if not n:
                    break
                one, other = first[:n], word[left[:n] + lag]
                cell, times = row[np.minimum(one, other)] + np.maximum(one, other), 1 + (both[:n] >= lag).astype(np.int32)
                if high - low < size:
                    least = np.minimum(one, other)
                    mine = (least >= low) & (least < high)
                    cell, times = cell[mine], times[mine]
                np.add.at(counts, cell, times)
                done += 2 * n
            return done

        def sums() -> Iterator[pd.DataFrame]:
            for start in range(low, high, rows):
                end = min(start + rows, high)
                part = np.zeros((end - start, size), dtype=np.int32)
                for term in range(start, end):
                    part[term - start, term:] = counts[row[term] + term : row[term] + size]
                part = part.ravel()
                cells = np.flatnonzero(part)
                if len(cells) or own[start:end].any() or held[start:end].any():
                    yield pd.DataFrame({
                        "slice": [start // rows], "cells": [cells.astype("<u4").tobytes()], "counts": [part[cells].tobytes()],
                        "own": [own[start:end].tobytes()], "held": [held[start:end].tobytes()]})
            counts[:], own[:], held[:] = 0, 0, 0

        for batch in batches:
            docs, words = [], 0
            for data in batch["words"]:
                coded = np.frombuffer(data, dtype=kind)
                held[np.unique(coded[coded != OTHER])] += 1
                held[OTHER] += 1
                # Stretches of a very long document share a half passage, which each counts with one of its passages.
                for start in range(0, max(len(coded) - HALF, min(len(coded), 1)), PORTION):
                    docs.append(coded[start : start + PORTION + HALF])
                    words += len(docs[-1])
                    if words >= PORTION:
                        pairs += add(docs)
                        docs, words = [], 0
                        if pairs >= SEND_PAIRS:
                            yield from sums()
                            pairs = 0
            if docs:
                pairs += add(docs)
        yield from sums()

    return gives_back(run)


def _sum_slices(size: int):
    """The sums of each slice, of rows that lie together by ``slice``."""
    rows = slice_rows(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, tuple[np.ndarray, ...]] = {}
        for batch in batches:
            for part in batch.itertuples(index=False):
                if part.slice not in total:
                    n = min(rows, size - part.slice * rows)
                    total[part.slice] = tuple(np.zeros(k, dtype=np.int64) for k in (n * size, n, n))
                counts, own, held = total[part.slice]
                counts[np.frombuffer(part.cells, dtype="<u4")] += np.frombuffer(part.counts, dtype=np.int32)
                own += np.frombuffer(part.own, dtype=np.int64)
                held += np.frombuffer(part.held, dtype=np.int64)
        for number, sums in total.items():
            yield pd.DataFrame({"slice": [number]} | {name: [one.tobytes()] for name, one in zip(("counts", "own", "held"), sums)})

    return gives_back(run)


def pair_counts(coded: DataFrame, kind: str, size: int) -> DataFrame:
    """(slice, counts, own, held) of all documents; a slice holds ``slice_rows`` terms of ``size``.

    A pair is counted at its lesser term. With U the matrix of counts and D the diagonal one of own, U + U' + D is A'A, of the passages' numbers of words A. held: documents with the term.
    """
    rows = slice_rows(size)
    parts, low = None, 0
    while low < size:
        # So many terms at once that a task's counts have a bound; with 200 items that is one pass.
        high = low + rows
        while high < size and (high + rows - low) * (2 * size - low - high - rows) // 2 <= CELLS:
            high += rows
        high = min(high, size)
        made = coded.mapInPandas(_count_pairs(kind, size, low, high), "slice int, cells binary, counts binary, own binary, held binary")
        parts, low = made if parts is None else parts.unionByName(made), high
    dealt = parts.repartition(max(1, -(-size // (rows * SLICES_AT_ONCE))), "slice")
    return dealt.mapInPandas(_sum_slices(size), "slice int, counts binary, own binary, held binary")


def _halves(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Half passages, a row each, filled up with other words, two at least a document; and the first half of every passage."""
    counts = np.array([max(2, -(-len(words) // HALF)) for words in docs])
    ends = np.cumsum(counts)
    halves = np.full((ends[-1], HALF), OTHER, dtype=docs[0].dtype)
    flat = halves.ravel()
    for words, begin in zip(docs, ((ends - counts) * HALF).tolist()):
        flat[begin : begin + len(words)] = words
    first = np.ones(ends[-1], dtype=bool)
    first[ends - 1] = False
    return halves, np.flatnonzero(first)


def _sums(halves: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of the terms' rows of ``table`` over each row of ``halves``; other words have no weight.

    First the first term of every half is added, then the second of those that have two, and so on.
    """
    half, place = np.nonzero(halves)
    known = np.bincount(half, minlength=len(halves))
    packed = np.zeros_like(halves)
    packed[half, np.arange(len(half)) - np.repeat(np.cumsum(known) - known, known)] = halves[half, place]
    order = np.argsort(-known, kind="stable")
    packed, total = packed[order], np.zeros((len(halves), table.shape[1]), dtype=table.dtype)
    for k, n in enumerate(np.searchsorted(-known[order], -np.arange(1, HALF + 1), "right").tolist()):
        if not n:
            break
        total[:n] += table[packed[:n, k]]
    sums = np.empty_like(total)
    sums[order] = total
    return sums


def _gram(idf: np.ndarray, basis: np.ndarray):
    """Aᵀ A B of a task's slices of pair counts, A weighted by ``idf``, for the basis B."""
    size = len(idf)
    rows = slice_rows(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = basis * idf[:, None]
        total = np.zeros(basis.shape)
        for batch in batches:
            for start in range(0, len(batch), SLICES_AT_ONCE):
                part = batch.iloc[start : start + SLICES_AT_ONCE]
                own = [np.frombuffer(data, dtype=np.int64) for data in part["own"]]
                at = np.concatenate([np.arange(number * rows, number * rows + len(one)) for number, one in zip(part["slice"], own)])
                counts = np.concatenate([np.frombuffer(data, dtype=np.int64) for data in part["counts"]]).reshape(len(at), size).astype(np.float64)
                total[at] += counts @ table + np.concatenate(own)[:, None] * table[at]
                total += counts.T @ table[at]
        total *= idf[:, None]
        for number, part in enumerate(np.array_split(total, RANGES)):
            yield pd.DataFrame({"slice": [number], "sums": [part.tobytes()]})

    return gives_back(run)


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(data, dtype=np.float64) for data in group["sums"])
    return pd.DataFrame({"slice": [int(group["slice"].iloc[0])], "sums": [total.tobytes()]})


def item_vectors(items: Items, idf: np.ndarray) -> np.ndarray:
    own = np.zeros((len(items.words), len(idf)), dtype=np.float32)
    for k, words in enumerate(items.words):
        np.add.at(own[k], words, idf[words])
    return own


def with_items(vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``vectors`` and an orthonormal basis of what they leave of the items: all of every item lies in the span.

    A passage's cosine with an item in that space is at least the one over all terms.
    """
    rest = own.astype(np.float64) - (own @ vectors).astype(np.float64) @ vectors.T
    basis, values, _ = np.linalg.svd(rest.T, full_matrices=False)
    return np.hstack([vectors, basis[:, values > 1e-3 * np.linalg.norm(own, axis=1).max()].astype(np.float32)])


def singular_vectors(pairs: DataFrame, own: np.ndarray, idf: np.ndarray, rank: int, rounds: int) -> np.ndarray:
    """The leading right singular vectors (terms by rank) of the documents' passages, given by their pair counts, and of the benchmark's."""
    terms = len(idf)
    width = min(rank + OVERSAMPLE, terms)
    basis = np.random.default_rng(17).standard_normal((terms, width))
    for step in range(rounds + 1):
        parts = pairs.select("slice", "counts", "own").mapInPandas(_gram(idf, basis), "slice int, sums binary")
        # Summed range by range, so that the driver gets terms x width numbers in all.
        mixed = parts.groupBy("slice").applyInPandas(_add, "slice int, sums binary")
        # A file of slices is some 16 MB, which a task would hold several times over if it went to Python at once.
        with small_batches(pairs.sparkSession):
            ranges = {row["slice"]: np.frombuffer(row["sums"], dtype=np.float64) for row in mixed.collect()}
        product = np.concatenate([ranges[number] for number in sorted(ranges)]).reshape(terms, width) if ranges else np.zeros((terms, width))
        mine = own.T @ (own @ basis)
        weight = max(1.0, np.linalg.norm(product) / max(np.linalg.norm(mine), 1e-12))
        product += weight * mine
        if step < rounds:
            basis, _ = np.linalg.qr(product)
    values, turn = np.linalg.eigh(basis.T @ product)
    return (basis @ turn[:, ::-1][:, :rank]).astype(np.float32)


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of the first sequence."""
    full = (1 << size) - 1
    row = full
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def bit_masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, word in enumerate(words.tolist()):
        masks[word] = masks.get(word, 0) | 1 << k
    return masks


def passage_weight(words: np.ndarray, idf: np.ndarray) -> float:
    """The most weight that ``PASSAGE`` words in a row of the item have."""
    sums = np.concatenate([[0.0], np.cumsum(idf[words])])
    return float((sums[PASSAGE:] - sums[:-PASSAGE]).max()) if len(words) > PASSAGE else float(sums[-1])


def _searcher(shared, kind: str, cosine: float, shared_weight: float, verbatim: float, paraphrase: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, table, queries, idf = shared.value
        masks = [bit_masks(words) for words in items.words]
        answers = [bit_masks(words) for words in items.answers]
        enough = [shared_weight * passage_weight(words, idf) for words in items.words]

        def check(words: np.ndarray, passage: int, k: int) -> tuple[float, bool]:
            around = max(HALF, len(items.words[k]))
            region = words[max(0, passage * HALF - around) : passage * HALF + PASSAGE + around]
            region = region[region != OTHER].tolist()
            share = common_subsequence(masks[k], len(items.words[k]), region) / len(items.words[k])
            answered = False
            if share >= paraphrase:
                answered = common_subsequence(answers[k], len(items.answers[k]), region) >= 0.8 * len(items.answers[k])
            return share, answered

        def search(ids: list, docs: list[np.ndarray]) -> list[tuple]:
            halves, first = _halves(docs)
            sums = _sums(halves, table)
            rows = sums[first] + sums[first + 1]
            passages = [max(1, -(-len(words) // HALF) - 1) for words in docs]
            owner = np.repeat(np.arange(len(docs)), passages)
            place = np.arange(len(first)) - np.repeat(np.cumsum(passages) - passages, passages)
            norm = np.linalg.norm(rows, axis=1)
            pairs: list[tuple[int, int]] = []
            near = (rows @ queries.T) / np.maximum(norm, 1e-9)[:, None]
            best: dict[tuple[int, int], tuple] = {}
            window = np.hstack([halves[first], halves[first + 1]])
            by_item, at = np.nonzero(near.T >= cosine)
            for k in np.unique(by_item).tolist():
                rs = at[slice(*np.searchsorted(by_item, [k, k + 1]))]
                worth = np.zeros(len(idf), dtype=np.float32)
                worth[items.words[k]] = idf[items.words[k]]
                held = worth[window[rs]].sum(axis=1)
                pairs.extend((r, k) for r in rs[held >= enough[k]].tolist())
            for r, k in pairs:
                share, answered = check(docs[owner[r]], int(place[r]), int(k))
                if share >= verbatim or (share >= paraphrase and answered):
                    found = (share, answered, float(near[r, k]), int(place[r]) * HALF)
                    old = best.get((int(owner[r]), int(k)))
                    if old is None or found[0] > old[0]:
                        best[int(owner[r]), int(k)] = found
            return [(ids[d], items.ids[k], *found) for (d, k), found in best.items()]

        limit = max(64, ROWS_AT_ONCE * 256 // max(1, len(items.ids)))
        for batch in batches:
            out, ids, docs, held = [], [], [], 0
            for doc_id, data in zip(batch["doc_id"], batch["words"]):
                words = np.frombuffer(data, dtype=kind)
                # A very long document is searched in stretches that overlap by the longest region.
                step = limit * HALF
                lap = 2 * PASSAGE + 2 * max(map(len, items.words))
                for start in range(0, len(words), step):
                    ids.append(doc_id)
                    docs.append(words[start : start + step + lap])
                    held += len(docs[-1]) // HALF + 1
                    if held >= limit:
                        out += search(ids, docs)
                        ids, docs, held = [], [], 0
            if docs:
                out += search(ids, docs)
            frame = pd.DataFrame(out, columns=["doc_id", "item_id", "share", "answered", "cosine", "word"])
            yield frame.astype({"doc_id": "Int64", "item_id": "Int64", "share": "float64", "answered": "bool", "cosine": "float64", "word": "int64"})

    return gives_back(run)


FOUND = "doc_id long, item_id long, share double, answered boolean, cosine double, word long"


def leaks(
    docs: DataFrame, benchmark: DataFrame, rank: int = 128, rounds: int = 2, cosine: float = 0.1,
    shared_weight: float = 0.45, verbatim: float = 0.8, paraphrase: float = 0.7, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document and item found in it: share of the item's words in common order, answered, cosine.

    Documents that repeat an id are one document here: the best share counts.
    """
    spark = docs.sparkSession
    has_answer = "answer" in benchmark.columns
    columns = ["item_id", "text", *["answer"] * has_answer]
    blocks = max(1, -(-benchmark.count() // ITEMS_AT_ONCE))
    result = None
    for block in range(blocks):
        chosen = benchmark.select(*columns).filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # About ITEMS_AT_ONCE rows of the benchmark, the stated query set.
        items = read_items(chosen.orderBy("item_id", "text").collect(), has_answer)
        if not items.ids:
            continue
        kind = _kind(items)
        source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        coded = stored(source.mapInArrow(_encoder(spark.sparkContext.broadcast(items)), "doc_id long, words binary"), "leak-words")
        size = len(items.terms) + 1
        pairs = stored(pair_counts(coded, kind, size), "leak-pairs")
        counts = np.zeros(size)
        for row in pairs.select("slice", "held").toLocalIterator():
            held = np.frombuffer(row["held"], dtype=np.int64)
            counts[row["slice"] * slice_rows(size) :][: len(held)] = held
        total = counts[OTHER]
        idf = np.log((1 + total) / (1 + counts)).clip(0.01)
        idf[OTHER] = 0
        own = item_vectors(items, idf)
        vectors = with_items(singular_vectors(pairs, own, idf, min(rank, len(items.terms)), rounds), own)
        table = (vectors * idf[:, None]).astype(np.float32)
        queries = np.stack([table[words].sum(axis=0) for words in items.words])
        queries /= np.maximum(np.linalg.norm(queries, axis=1), 1e-9)[:, None]
        shared = spark.sparkContext.broadcast((items, table, queries, idf))
        found = coded.mapInPandas(_searcher(shared, kind, cosine, shared_weight, verbatim, paraphrase), FOUND)
        result = found if result is None else result.unionByName(found)
    if result is None:
        return no_rows(spark, FOUND)
    best = F.struct("share", "answered", "cosine", "word")
    return result.groupBy("doc_id", "item_id").agg(F.max(best).alias("best")).select("doc_id", "item_id", "best.share", "best.answered", "best.cosine", "best.word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows that repeat an id share its fate."""
    names = [F.col(f"`{name}`") for name in docs.columns]
    gone = stored(leaks(docs, benchmark, key=key, text=text, **options).select("doc_id").distinct(), "leak-docs").select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, docs[f"`{key}`"].cast("long").eqNullSafe(gone["__gone"]), "left_anti").select(*names)
