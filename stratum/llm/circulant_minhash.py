"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

*Signature.* Two permutations make all coordinates. The first scatters the shingles over the residues modulo 2^32 (the upper half
of a 64-bit hash), the second is a fixed bijection of these residues, and coordinate k takes the least value of it
shifted circularly by k. So a signature of any length needs two functions, not one a coordinate.

*Bands.* ``BANDS`` keys of ``ROWS`` coordinates each. A pair of Jaccard similarity 0.8 shares no key with probability
(1 - 0.8^6)^48 = 5e-7, and less the nearer the texts.

*Candidates.* Equal sets are one node before anything else, so copies cost one row. Within a key the node with the smallest
number is a star's centre; all others are compared with it, and links are joined to classes. Keys with the same centre are one group then, with
a row for each member, whatever the number of keys that it shares; who shares a key shares a group. Where a group's
members still lie in several classes, a second centre is taken from outside the first one's class. What is left after that is
compared whole: members outside the centre's class with all members, in tiles of two chunks, each a bounded piece of work of
its own. Jaccard distance is a metric and each member's distance from the first centre is known, so two members whose distances from it differ
by more than a link allows need no comparison; that takes strays out of a large group of copies without looking at the group again. So within a group
every pair is compared, lies in one class already or cannot be linked, and no pair list is ever made.

*Verification.* 100 * |intersection| >= 100 * similarity * |union| on the whole sets of 64-bit shingle hashes, in integers.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Fewer words than ``width`` are one shingle. Without words (null, empty or
blank text) the set is empty and linked with nothing. Rows with a null id take part: their class is named by the smallest id in it, null
if there is none. Repeated ids are rows of their own. Long texts are taken whole, their shingles in blocks. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import ROW_ID, Stored, bit_map, spread

SEED = 42
BANDS, ROWS = 48, 6
SHINGLES_AT_ONCE = 256
# Bits of the map that tells which ids are wanted, whatever their number: 8 MB.
MAP_BITS = 1 << 26
CHUNK_SETS, CHUNK_SHINGLES = 1024, 1 << 21
KEY_FACTORS = np.random.default_rng(SEED).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles' XXH64 in rising order."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    grams = zip(*[words[k:] for k in range(width)]) if len(words) >= width else [words]
    return np.unique(np.fromiter((digest(b" ".join(gram), SEED) for gram in grams), dtype=np.uint64))


def permuted(values: np.ndarray) -> np.ndarray:
    """The second permutation, in place: every step is a bijection of the 32-bit residues."""
    spare = values >> np.uint32(16)
    values ^= spare
    values *= np.uint32(0x7FEB352D)
    np.right_shift(values, np.uint32(15), out=spare)
    values ^= spare
    values *= np.uint32(0x846CA68B)
    np.right_shift(values, np.uint32(16), out=spare)
    values ^= spare
    return values


def signature(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS coordinates of a set that is not empty."""
    scattered = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(SHIFTS), np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(scattered), SHINGLES_AT_ONCE):
        part = permuted(scattered[start : start + SHINGLES_AT_ONCE, None] + SHIFTS[None, :])
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A signed 64-bit key per band."""
    mixed = (signature(shingles).reshape(BANDS, ROWS).astype(np.uint64) * KEY_FACTORS).sum(axis=1, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def _signer(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, marks, keys, counts = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                marks.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                counts.append(BANDS if len(shingles) else 0)
                if len(shingles):
                    keys.append(band_keys(shingles))
            mark = np.frombuffer(b"".join(marks), dtype="<i8").reshape(-1, 2)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64))
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), flat)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(mark[:, 0].copy()), pa.array(mark[:, 1].copy()), bands]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "m1", "m2", "bands"])

    return run


def _sets(width: int, shared):
    """(bit, text) to (m1, m2, shingles), for rows whose bit is set in the map or null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            at = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            wanted = (at < 0) | ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
            made = [shingle_set(text.as_py(), width).tobytes() for text in batch.column(1).filter(pa.array(wanted))]
            mark = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, made)), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(mark[:, 0].copy()), pa.array(mark[:, 1].copy()), pa.array(made, pa.binary())], names=["m1", "m2", "shingles"])

    return run


def similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """100 * |intersection| >= percent * |union| of two rising arrays."""
    small, large = sorted((one, other), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    both = int((large[place] == small).sum())
    return 100 * both >= percent * (len(one) + len(other) - both)


def far(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard distance."""
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 1 - both / (len(one) + len(other) - both)


def _compare(percent: int):
    """(a, b, set of a, set of b) to (a, b, far, linked): their distance, and whether they are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in batch.column(k)] for k in (2, 3))
            linked = pa.array([similar(one, other, percent) for one, other in zip(left, right)], pa.bool_())
            apart = pa.array([far(one, other) for one, other in zip(left, right)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), apart, linked], names=["a", "b", "far", "linked"])

    return run


def tile_links(sets: list[np.ndarray], classes: np.ndarray, side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that join what all similar pairs of the tile would, beyond the classes joined already; with ``side``, pairs across only."""
    sizes = np.array([len(one) for one in sets])
    _, root = np.unique(classes, return_inverse=True)
    links = []
    for i in range(len(sets)) if side is None else np.flatnonzero(side == 0).tolist():
        others = root != root[i]
        others &= np.minimum(sizes, sizes[i]) * 100 >= percent * np.maximum(sizes, sizes[i])
        others &= (np.arange(len(sets)) > i) if side is None else (side == 1)
        for j in np.flatnonzero(others).tolist():
            if root[j] != root[i] and similar(sets[i], sets[j], percent):
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _tiles(percent: int):
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, low, high), tile in bucket.groupby(["key", "low", "high"], sort=False):
            sets = [np.frombuffer(data, dtype=np.uint64) for data in tile["shingles"]]
            side = None if low == high else (tile["chunk"].to_numpy() == high).astype(np.int64)
            nodes = tile["node"].to_numpy()
            found += [(nodes[i], nodes[j]) for i, j in tile_links(sets, tile["class"].to_numpy(), side, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _classes(links: DataFrame) -> Stored:
    return Stored(connected_components(links, "circulant-classes"), "circulant-classes")


def _with_class(members: DataFrame, classes: DataFrame) -> DataFrame:
    return members.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    both = right.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(_compare(percent), "a long, b long, far double, linked boolean")


def _open_members(members: DataFrame, reach: float) -> DataFrame:
    """Of ``members`` (key, node, class, main, far ...) those that may have a link to another class within their group; ``key`` is its first.

    Outside the main class all stay; inside it those that are no nearer to the first than ``reach`` below its nearest stray.
    """
    members = Stored(members, "circulant-classed").df
    stray = F.when(F.col("class") != F.col("main"), F.col("far"))
    nearest = members.groupBy("key").agg(F.min(stray).alias("nearest")).filter("nearest is not null")
    near = members.join(nearest, "key").filter((F.col("class") != F.col("main")) | (F.col("far") >= F.col("nearest") - reach)).drop("nearest")
    several = near.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("key")
    return near.join(several, "key")


def _rest_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``members`` (key, node, size, class, main): those outside the main class with all, in tiles."""
    print_of = F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")
    minor = F.col("class") != F.col("main")
    sizes = members.groupBy("key").agg(
        F.count("*").alias("n"), print_of, F.count(F.when(minor, 1)).alias("n_minor"), F.sum(F.when(minor, F.col("size"))).alias("s_minor"),
        F.count(F.when(~minor, 1)).alias("n_main"), F.sum(F.when(~minor, F.col("size"))).alias("s_main"),
    )
    once = sizes.groupBy("n", "members").agg(F.min_by(F.struct("key", "n_minor", "s_minor", "n_main", "s_main"), "key").alias("k")).select("k.*")

    def chunks(n: str, volume: str):
        return F.greatest(F.ceil(F.col(n) / CHUNK_SETS), F.ceil(F.coalesce(volume, F.lit(0)) / CHUNK_SHINGLES)).cast("int")

    dealt = once.select("key", chunks("n_minor", "s_minor").alias("p"), chunks("n_main", "s_main").alias("q"))
    # Chunks 0 to p - 1 hold the members outside the main class, p to p + q - 1 those inside.
    member = members.join(dealt, "key").withColumn(
        "chunk", F.when(minor, F.pmod(F.xxhash64("node"), "p")).otherwise(F.col("p") + F.pmod(F.xxhash64("node"), F.greatest("q", F.lit(1)))).cast("int"))
    member = Stored(member, "circulant-rest").df
    reach = F.when(minor, F.sequence(F.lit(0), F.col("p") + F.col("q") - 1)).otherwise(F.sequence(F.lit(0), F.col("p") - 1))
    total = member.agg(F.sum(F.col("size") * F.size(reach))).first()[0] or 0
    tiles = member.withColumn("other", F.explode(reach)).select(
        "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "class")
    buckets = max(12, -(-int(total) // CHUNK_SHINGLES))
    return tiles.join(sets, "node").withColumn("bucket", spread("key", "low", "high", parts=buckets)).groupBy("bucket").applyInPandas(_tiles(percent), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id of its class) and kept (whether that is its own)."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = source.mapInArrow(_signer(width), "id long, size long, m1 long, m2 long, bands array<long>")
    signed = Stored(rows.withColumn(ROW_ID, F.monotonically_increasing_id()), "circulant-signed").df
    nodes = Stored(signed.filter("size > 0").groupBy("m1", "m2").agg(
        F.min(ROW_ID).alias("node"), F.min("id").alias("least"), F.max("size").alias("size")), "circulant-nodes").df
    heads = signed.filter("size > 0").select(F.col(ROW_ID).alias("node"), "bands").join(nodes.select("node", "size"), "node")
    banded = heads.select(F.explode("bands").alias("key"), "node", "size")
    shared = banded.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1").select("key", "first")
    members = Stored(banded.join(shared, "key"), "circulant-members")
    wanted = Stored(members.df.select("node").distinct().join(nodes, "node"), "circulant-wanted").df
    # The texts of wanted sets are read again where they lie: a bit map of fixed size tells which, by their ids, and the join by the whole mark decides.
    # Rows without an id have no bit, so all of them are read.
    bit = F.pmod(F.xxhash64("id"), F.lit(MAP_BITS))
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(wanted.filter("least is not null").select(F.pmod(F.xxhash64("least"), F.lit(MAP_BITS)).alias("bit")), MAP_BITS))
    made = source.select(F.when(F.col("id").isNotNull(), bit).alias("bit"), "text").mapInArrow(_sets(width, shared), "m1 long, m2 long, shingles binary")
    sets = Stored(made.join(wanted.select("m1", "m2", "node"), ["m1", "m2"]).select("node", "shingles").dropDuplicates(["node"]), "circulant-sets")

    reach = 1 - percent / 100 + 1e-9
    stars = members.df.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    star = Stored(_verified(stars, sets.df, percent), "circulant-stars")
    links = star.df.filter("linked").select("a", "b")
    classes = _classes(links)
    # Keys with one first are one group from here on: a text that shares many keys with its first is one row, not one a key.
    spokes = star.df.select(F.col("a").alias("key"), F.col("b").alias("node"), "far").join(nodes.select("node", "size"), "node")
    held = _with_class(spokes, classes.df).withColumn("main", F.col("key"))
    mains = classes.df.select(F.col("node").alias("key"), F.col("component").alias("main_class"))
    held = held.join(mains, "key", "left").withColumn("main", F.coalesce("main_class", "key")).drop("main_class")
    open_ = Stored(_open_members(held, reach), "circulant-open")
    second = open_.df.filter("class <> main").groupBy("key").agg(F.min(F.struct("node", "far", "class")).alias("s")).select(
        "key", F.col("s.node").alias("second"), F.col("s.far").alias("second_far"), F.col("s.class").alias("second_class"))
    again = open_.df.join(second, "key").filter((F.col("class") != F.col("second_class")) & (F.abs(F.col("far") - F.col("second_far")) <= reach))
    again = again.select(F.col("second").alias("a"), F.col("node").alias("b")).distinct()
    star_again = Stored(_verified(again, sets.df, percent), "circulant-stars")
    both = links.unionByName(star_again.df.filter("linked").select("a", "b"))
    classes_again = _classes(both)
    left = _with_class(open_.df.drop("class").join(second.select("key", F.col("second").alias("node")), ["key", "node"], "left_anti"), classes_again.df)
    now = classes_again.df.select(F.col("node").alias("main"), F.col("component").alias("main_class"))
    left = left.join(now, "main", "left").withColumn("main", F.coalesce("main_class", "main")).drop("main_class")
    rest = Stored(_open_members(left, reach), "circulant-rest")
    tiled = Stored(_rest_links(rest.df, sets.df, percent), "circulant-links")
    final = _classes(both.unionByName(tiled.df))
    for table in (members, sets, star, star_again, tiled, open_, rest, classes, classes_again):
        table.drop()

    grouped = _with_class(nodes.select("node", "m1", "m2", "least"), final.df)
    names = grouped.groupBy("class").agg(F.min("least").alias("name"))
    named = grouped.join(names, "class").select("m1", "m2", "name")
    out = signed.select("id", "size", F.when(F.col("size") > 0, F.col("m1")).alias("m1"), F.when(F.col("size") > 0, F.col("m2")).alias("m2")).join(named, ["m1", "m2"], "left")
    component = F.when(F.col("size") > 0, F.col("name")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
