"""Exact deduplication with a cuckoo-filter index that takes insertions and deletions of live digests.

The index is a pair of tables per generation: for every bucket of the digest space a cuckoo filter
(16-bit fingerprints, four to a slot row, two rows per digest), and the bucketed content, the
live digests with what is stored for them. A digest that the filter does not know is new for
certain; a hit is verified against the content by an equi-join on the whole digest, so the
filter's false positives never decide. Deleting a digest takes its fingerprint out of
the filter and its row out of the content. A filter that overflows is rebuilt at twice the size
from the bucket's stored keys, until all of them fit.

Deduplication feeds the table to the index in ``SLICES`` slices by row. The filters tell the digests of a slice that are new from those that are
known, and only what they let through is compared with the content: a row better than the keeper replaces it there, its group grows, and
filters that overflow are rebuilt. So what the filters say decides what becomes a group.

Buckets hold about ``BUCKET_KEYS`` digests and are dealt by the digest, and digests are distinct
(copies are reduced to one row, map-side first) before they reach a bucket, so a group of
copies with a third of all rows is one key here.

Texts are equal when equal after white space (x20, x09 to x0D) is deleted. Null counts as empty.
Of equal texts the row with the most code points stays, then the smallest id (a null id after all
others), then one of equal rows. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import ROW_ID, Stored, maybe_among, no_rows, numbered, spread, stored, text_or_empty, wrapped

BUCKET_KEYS = 20_000
WAYS = 4
KICKS = 500
LOAD = 0.9
SLICES = 3
KEYS = "bucket int, digest string, keep_id long, keep_points int, group_size long"
FILTERS = "bucket int, rows int, cells binary"


def normalized(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def bucket_of(digest: Column, buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


class CuckooFilter:
    """A multiset of 16-bit fingerprints; ``insert`` returns False when a place cannot be found."""

    def __init__(self, rows: int, cells: np.ndarray | None = None):
        self.rows = rows
        self.cells = np.zeros((rows, WAYS), dtype=np.uint16) if cells is None else cells

    @staticmethod
    def sized(keys: int) -> CuckooFilter:
        return CuckooFilter(1 << max(1, math.ceil(math.log2(max(1, keys) / (WAYS * LOAD)))))

    @staticmethod
    def prints(digests: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints (never zero) and the hash that picks the first row, from digits 9 to 28 of the digest."""
        mark = np.array([int(d[8:12], 16) for d in digests], dtype=np.int64)
        place = np.array([int(d[12:28], 16) >> 1 for d in digests], dtype=np.int64)
        return np.maximum(mark, 1), place

    def places(self, mark, place):
        first = place & (self.rows - 1)
        return first, first ^ ((mark * 0x5BD1E995) & (self.rows - 1))

    def insert(self, mark: int, place: int) -> bool:
        first, second = self.places(mark, place)
        for row in (first, second):
            for way in range(WAYS):
                if not self.cells[row, way]:
                    self.cells[row, way] = mark
                    return True
        row = second
        for kick in range(KICKS):
            way = kick % WAYS
            mark, self.cells[row, way] = int(self.cells[row, way]), mark
            row = row ^ ((mark * 0x5BD1E995) & (self.rows - 1))
            for way in range(WAYS):
                if not self.cells[row, way]:
                    self.cells[row, way] = mark
                    return True
        return False

    def delete(self, mark: int, place: int) -> bool:
        for row in self.places(mark, place):
            for way in range(WAYS):
                if self.cells[row, way] == mark:
                    self.cells[row, way] = 0
                    return True
        return False

    def contains(self, mark: np.ndarray, place: np.ndarray) -> np.ndarray:
        first, second = self.places(mark, place)
        return ((self.cells[first] == mark[:, None]) | (self.cells[second] == mark[:, None])).any(axis=1)


def filled(current: CuckooFilter | None, new: list[str], stored_keys: list[str]) -> CuckooFilter:
    """``current`` with ``new`` added; on overflow a larger one from all stored keys."""
    if current is not None:
        marks, places = CuckooFilter.prints(new)
        if all(current.insert(mark, place) for mark, place in zip(marks.tolist(), places.tolist())):
            return current
    keys = [*stored_keys, *new]
    marks, places = CuckooFilter.prints(keys)
    fresh = CuckooFilter.sized(len(keys))
    while not all(fresh.insert(mark, place) for mark, place in zip(marks.tolist(), places.tolist())):
        fresh = CuckooFilter(fresh.rows * 2)
    return fresh


def _load(state: pd.DataFrame) -> CuckooFilter | None:
    if not len(state):
        return None
    rows = int(state["rows"].iloc[0])
    return CuckooFilter(rows, np.frombuffer(state["cells"].iloc[0], dtype=np.uint16).reshape(rows, WAYS).copy())


def _state(bucket: int, current: CuckooFilter) -> pd.DataFrame:
    return pd.DataFrame({"bucket": [bucket], "rows": [current.rows], "cells": [current.cells.tobytes()]})


def _change(key, state: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """The filter of a bucket after its changes: 'live' keys were there, 'in' are added, 'out' are taken away."""
    by = {kind: changes.loc[changes["kind"] == kind, "digest"].tolist() for kind in ("live", "in", "out")}
    current = _load(state)
    gone = set(by["out"])
    if current is not None:
        marks, places = CuckooFilter.prints(by["out"])
        for mark, place in zip(marks.tolist(), places.tolist()):
            current.delete(mark, place)
    kept = [digest for digest in by["live"] if digest not in gone]
    if current is None and not kept and not by["in"]:
        return pd.DataFrame({"bucket": [], "rows": [], "cells": []})
    return _state(key[0], filled(current, by["in"], kept))


def _probe(key, wanted: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
    current = _load(state)
    if current is None or not len(wanted):
        return pd.DataFrame({"digest": []}, dtype="object")
    marks, places = CuckooFilter.prints(wanted["digest"].tolist())
    return wanted.loc[current.contains(marks, places), ["digest"]]


class CuckooIndex:
    """Live digests with their keepers. Every change makes a new generation of tables; ``drop`` deletes one that nothing reads any more."""

    def __init__(self, spark: SparkSession, buckets: int, keys: Stored | None = None, filters: Stored | None = None):
        self.spark, self.buckets, self._tables = spark, buckets, [table for table in (keys, filters) if table]
        self.keys = no_rows(spark, KEYS) if keys is None else keys.df
        self.filters = no_rows(spark, FILTERS) if filters is None else filters.df

    def drop(self) -> None:
        for table in self._tables:
            table.drop()

    @staticmethod
    def for_size(spark: SparkSession, digests: int) -> CuckooIndex:
        return CuckooIndex(spark, max(1, -(-digests // BUCKET_KEYS)))

    def probe(self, digests: DataFrame) -> DataFrame:
        """The rows of the content whose digest is in ``digests``: filter hits, verified."""
        wanted = digests.select("digest").distinct().withColumn("bucket", bucket_of(F.col("digest"), self.buckets))
        hits = wanted.groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInPandas(_probe, "digest string")
        return self.keys.join(hits, "digest", "left_semi")

    def _changed(self, keys: DataFrame, added: DataFrame, removed: DataFrame) -> CuckooIndex:
        content = Stored(keys, "cuckoo-keys")
        touched = added.select("bucket").unionByName(removed.select("bucket")).distinct()
        live = self.keys.join(touched, "bucket", "left_semi").select("bucket", "digest", F.lit("live").alias("kind"))
        changes = live.unionByName(added.select("bucket", "digest", F.lit("in").alias("kind"))).unionByName(
            removed.select("bucket", "digest", F.lit("out").alias("kind"))
        )
        before = self.filters.join(touched, "bucket", "left_semi")
        made = before.groupBy("bucket").cogroup(changes.groupBy("bucket")).applyInPandas(_change, FILTERS)
        same = self.filters.join(touched, "bucket", "left_anti")
        return CuckooIndex(self.spark, self.buckets, content, Stored(made.unionByName(same), "cuckoo-filters"))

    def insert(self, live: DataFrame) -> CuckooIndex:
        """With the distinct digests of ``live`` (digest, keep_id, keep_points, group_size); those known already keep their better row."""
        arriving = live.withColumn("bucket", bucket_of(F.col("digest"), self.buckets)).select(*self.keys.columns)
        known = self.probe(arriving)
        known = Stored(known.select("digest"), "cuckoo-known")
        new = Stored(arriving.join(known.df, "digest", "left_anti").select(*self.keys.columns), "cuckoo-new")
        better = F.struct("keep_points", -F.coalesce("keep_id", F.lit((1 << 63) - 1)))
        again = arriving.join(known.df, "digest", "left_semi").select(*self.keys.columns)
        merged = self.keys.unionByName(again).groupBy("bucket", "digest").agg(
            F.max_by(F.struct("keep_id", "keep_points"), better).alias("best"), F.sum("group_size").alias("group_size")
        ).select("bucket", "digest", "best.keep_id", "best.keep_points", "group_size")
        changed = self._changed(merged.unionByName(new.df), new.df, self.keys.limit(0))
        known.drop()
        new.drop()
        return changed

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Without the digests given; those that are not live do not matter."""
        gone = stored(self.probe(digests), "cuckoo-gone")
        return self._changed(self.keys.join(gone.select("digest"), "digest", "left_anti").select(*self.keys.columns), self.keys.limit(0), gone)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, points): the SHA-256 of the normalized whole text and the code points of the original."""
    body = text_or_empty(text)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.sha2(normalized(body).cast("binary"), 256).alias("digest"),
        F.length(body).alias("points"),
    )


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the keeper and the size, by two hash aggregates on fixed-width values."""
    last = F.lit((1 << 63) - 1)
    per_length = rows.groupBy("digest", "points").agg(F.min(F.coalesce("doc_id", last)).alias("least"), F.count("*").alias("n"))
    best = per_length.groupBy("digest").agg(
        F.max_by("least", "points").alias("least"), F.max("points").alias("keep_points"), F.sum("n").alias("group_size")
    )
    return best.select("digest", F.nullif(F.col("least"), last).alias("keep_id"), "keep_points", "group_size")


def indexed(rows: DataFrame) -> CuckooIndex:
    """An index of all ``rows`` (doc_id, digest, points), fed slice by slice."""
    index = CuckooIndex.for_size(rows.sparkSession, rows.count())
    for slice_ in range(SLICES):
        before, part = index, Stored(groups(rows.filter(spread("doc_id", "digest", "points", parts=SLICES) == slice_)), "dedup-slice")
        index = before.insert(part.df)
        part.drop()
        before.drop()
    return index


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, through an index built from the table."""
    rows = numbered(digests(docs, key, text), "dedup-digests")
    index = indexed(rows)
    verified = stored(index.probe(rows).select("digest", "keep_id", "keep_points", "group_size"), "dedup-verified")
    index.drop()
    joined = rows.join(verified, "digest")
    candidate = (F.col("points") == F.col("keep_points")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Of equal rows with the keeper's id, one stays.
    first = joined.filter(candidate).groupBy("digest").agg(F.min(ROW_ID).alias("first"))
    return joined.join(stored(first, "dedup-first"), "digest").select(
        "doc_id", "keep_id", "group_size", (F.col(ROW_ID) == F.col("first")).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that do not stay; of rows with equal id and equal text one is kept.

    Decided on slim rows (id, digest, points). Texts stay where they are, except those of rows whose id is also that of a row that goes, or null.
    """
    slim = Stored(digests(docs, key, text), "dedup-digests")
    index = indexed(slim.df)
    keep = index.probe(slim.df).select("digest", "keep_id", "keep_points")
    stays = (F.col("points") == F.col("keep_points")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    judged = slim.df.join(keep, "digest").groupBy("doc_id", "digest").agg(
        F.count("*").alias("n"), F.max(stays).alias("stays"), F.max("keep_points").alias("keep_points"))
    pairs = Stored(judged.filter("not stays or n > 1"), "dedup-pairs").df
    index.drop()
    body = text_or_empty(text)
    every = docs.select(wrapped(docs), F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("body"))
    marked = maybe_among("doc_id", every, pairs.select("doc_id").distinct())
    doubtful = F.col("meant") | F.col("doc_id").isNull()
    seen = marked.filter(doubtful).select(
        "row", "doc_id", F.sha2(normalized(F.col("body")).cast("binary"), 256).alias("digest"), F.length("body").alias("points"))
    right = pairs.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "stays", "keep_points")
    told = seen.join(right, F.col("digest").eqNullSafe(F.col("d")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    single = told.filter("d is null").select("row.*")
    # Rows that share the keeper's id and text: one of those with its length.
    tied = told.filter("stays and points = keep_points").groupBy("digest").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    out = marked.filter(~doubtful).select("row.*").unionByName(single).unionByName(tied)
    slim.drop()
    return out
