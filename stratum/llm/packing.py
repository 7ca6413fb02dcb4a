"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids, closed by an end id, are cut into pieces of the window's capacity and a rest. Full
pieces are windows of their own. The rests are dealt by hash into groups of about ``GROUP`` pieces;
in a group they are differenced into as many windows as their sum needs: every piece
starts as a partition with one window in use, the two partitions with the largest imbalance merge, the
fullest window of one with the emptiest of the other, until one partition is left. If its
fullest window is above the capacity, the number of windows rises and differencing starts anew.

The groups bound the work of a task whatever the input's size. Pieces are numbered when they are
written, and dealt by that number, so repeated rows and ids spread like others. Null and
empty texts are documents of the end id alone; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import ROW_ID, gives_back, numbered, spread
from .words import Codes, default_tokenizer

GROUP = 512
CHARS_AT_ONCE = 500_000


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (from 0) of every size, by largest differencing into ``windows`` parts."""
    n = len(sizes)
    sums: list[np.ndarray | None] = []
    heap: list[tuple[int, int]] = []
    for k, size in enumerate(sizes.tolist()):
        own = np.zeros(windows, dtype=np.int64)
        own[0] = size
        sums.append(own)
        heap.append((-size, k))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        merged = both[order]
        sums[a] = sums[b] = None
        sums.append(merged)
        merges.append((a, b, order))
        heapq.heappush(heap, (int(merged[-1] - merged[0]), n + len(merges) - 1))
    window = np.zeros(n, dtype=np.int64)
    labels: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)} if heap else {}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = labels.pop(n + k)
        first = np.empty(windows, dtype=np.int64)
        first[order] = own
        labels[a], labels[b] = first, first[::-1]
    for k in range(n):
        window[k] = labels[k][0]
    return window


def windows_for(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of at most ``capacity``, as few as differencing finds while their number rises."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, windows)
        fullest = int(np.bincount(window, weights=sizes, minlength=windows).max())
        if fullest <= capacity:
            return window
        windows += max(1, windows // 100)


def _cutter(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            at = 0
            while at < len(column):
                texts, held, begin = [], 0, at
                while at < len(column) and held < CHARS_AT_ONCE:
                    texts.append(column[at].as_py() or "")
                    held += len(texts[-1])
                    at += 1
                owner, start, ids, total = [], [], [], []
                for k, text in enumerate(texts):
                    data = codes.encode(text) + end
                    for low in range(0, len(data), step):
                        owner.append(begin + k)
                        start.append(low // 4)
                        ids.append(data[low : low + step])
                        total.append(len(data) // 4)
                kept = [batch.column(i).take(pa.array(owner)) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(start, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                    names=[*batch.schema.names[:-1], "start", "ids", "doc_tokens"],
                )

    return gives_back(cut)


def pieces(
    docs: DataFrame, capacity: int = 1024, end_id: int = 0, tokenizer: str | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The kept columns, start, ids (binary, little-endian unsigned 32 bit), length and doc_tokens of every piece."""
    source = docs.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keep)], F.col(text).alias("text"))
    kinds = [f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    cut = source.mapInArrow(
        _cutter(tokenizer or default_tokenizer(), capacity, end_id), ", ".join([*kinds, "start long, ids binary, doc_tokens long"])
    )
    return cut.select(
        *[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)], "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        "ids", "doc_tokens",
    )


def _place(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(ROW_ID).reset_index(drop=True)
        window = windows_for(group["length"].to_numpy(), capacity)
        order = np.lexsort((group.index, window))
        group = group.iloc[order].reset_index(drop=True)
        window = window[order]
        length = group["length"].to_numpy()
        before = np.cumsum(length) - length
        head = np.concatenate([[True], window[1:] != window[:-1]])
        group["offset"] = before - before[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        group["sequence_id"] = 2 * (group["__group"].to_numpy(np.int64) * (1 << 20) + window)
        return group.drop(columns=["__group"])

    return run


def pack(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """``parts`` (``length`` of at most ``capacity`` and any other columns) with sequence_id and offset.

    What the columns hold is written once and shuffled once, so leave out what is not needed.
    """
    rows = numbered(parts, "pack-pieces")
    rests = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // GROUP))
    dealt = rests.withColumn("__group", spread(F.lit("pack"), F.col(ROW_ID), parts=groups))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["offset long", "sequence_id long"]
    placed = dealt.groupBy("__group").applyInPandas(_place(capacity), ", ".join(kinds))
    full = rows.filter(F.col("length") >= capacity).select("*", F.lit(0).cast("long").alias("offset"), (2 * F.col(ROW_ID) + 1).alias("sequence_id"))
    return placed.unionByName(full).drop(ROW_ID)
