"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits have a word in the middle that differs from
each in at most ``r``. So every fingerprint emits all variants within ``r`` bits of itself, and those
that share a variant are linked. Variants number 2,081 per fingerprint at ``r = 2``, so what is
shuffled decides the cost. It happens in two steps, both exact in what they lose, which is nothing:

1. Every variant goes to its bucket as a hashed key of just enough bits, sorted and delta-coded,
   about two bytes each. A bucket reports the keys that came more than once, a few in a
   thousand beside those of real neighbours, back to the blocks they came from.
2. The blocks make their variants again and send those whose key was reported, whole and with
   their fingerprint. What shares a whole variant is linked, after its distance is checked.

Fingerprints are distinct before the first step (a group of exact copies is one), and no variant
lies in more balls than a ball has words, so no bucket can be unbounded. A bucket or block
links its members by a spanning forest, never by all pairs; members of one bucket
are all within ``2 r`` bits by construction, so the forest joins what the pairs would.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Stored, gives_back, gives_back_groups, maybe_among, spread, stored, without_ids

SEED = 42
BLOCK_ROWS = 1024
BUCKET_VARIANTS = 3_000_000
SLACK = 6
SHINGLES_AT_ONCE = 1 << 16
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z as a-z; white space is exactly x20 and x09 to x0D."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingle_hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """XXH64 of the space-joined shingles, in blocks; fewer words than ``width`` are one shingle."""
    digest = xxhash.xxh64_intdigest
    for start in range(0, max(1, len(words) - width + 1), SHINGLES_AT_ONCE):
        part = words[start : start + SHINGLES_AT_ONCE + width - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(word) + 1 for word in part])
        starts = [0, *ends[:-1].tolist()]
        last = (ends[min(width, len(part)) - 1 :] - 1).tolist()
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], dtype=np.uint64)


def fingerprint(words: list[bytes], width: int) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; zero without words."""
    if not words:
        return 0
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(words, width):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprinter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(words_of(text.as_py()), width) for text in batch.column(batch.num_columns - 1)]
            signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, signed], names=[*batch.schema.names[:-1], "fingerprint"])

    return gives_back(run)


def fingerprints(docs: DataFrame, width: int = 4, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns and ``fingerprint`` (a bigint with the 64 bits) of every row, from its whole text."""
    source = docs.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keep)], F.col(text).alias("text"))
    kinds = [f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    made = source.mapInArrow(_fingerprinter(width), ", ".join([*kinds, "fingerprint long"]))
    return made.select(*[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)], "fingerprint")


def hex_of(column: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def masks(radius: int, width: int = 64) -> np.ndarray:
    """All words of ``width`` bits with at most ``radius`` bits set."""
    bits = [1 << k for k in range(width)]
    return np.array([sum(some) for n in range(radius + 1) for some in combinations(bits, n)], dtype=np.uint64)


def _variants(prints: np.ndarray, ball: np.ndarray) -> np.ndarray:
    return (prints[:, None] ^ ball[None, :]).ravel()


def _keys(variants: np.ndarray, bits: int) -> np.ndarray:
    mixed = variants * MIX
    mixed ^= mixed >> np.uint64(32)
    mixed *= MIX
    mixed >>= np.uint64(64 - bits)
    return mixed


def encode(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys as ``width``-byte gaps; a gap too large is cut by filling gaps of the largest value."""
    most = (1 << (8 * width)) - 1
    gaps = np.diff(keys, prepend=np.uint64(0)).astype(np.int64)
    fills, rest = gaps // most, gaps % most
    out = np.full(len(gaps) + int(fills.sum()), most, dtype=np.uint32)
    out[np.cumsum(fills + 1) - 1] = rest
    return out.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def decode(data: bytes, width: int) -> np.ndarray:
    most = (1 << (8 * width)) - 1
    wide = np.zeros((len(data) // width, 4), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    gaps = wide.view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.uint64)[gaps != most]


class Plan:
    """Sizes that follow from the number of distinct fingerprints and the radius."""

    def __init__(self, count: int, radius: int, width: int = 64, slack: int = SLACK):
        self.radius = radius
        self.ball = masks(radius // 2, width)
        variants = max(1, count) * len(self.ball)
        self.blocks = max(1, -(-count // BLOCK_ROWS))
        self.buckets = max(1, -(-variants // BUCKET_VARIANTS))
        self.bucket_bits = max(1, (self.buckets - 1).bit_length())
        self.buckets = 1 << self.bucket_bits
        # 2 ** slack times as many keys as variants, so one in so many meets another by chance.
        self.bits = min(60, variants.bit_length() + slack)
        gap_bits = self.bits - (min(count, BLOCK_ROWS) * len(self.ball)).bit_length() + 3
        self.width = min(4, max(1, -(-gap_bits // 8)))

    def start(self, bucket: int) -> np.uint64:
        return np.uint64(int(bucket) << (self.bits - self.bucket_bits))

    def split(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Sorted keys by bucket, counted from the bucket's start."""
        edges = np.searchsorted(keys, np.array([self.start(bucket) for bucket in range(self.buckets + 1)], dtype=np.uint64))
        for bucket in range(self.buckets):
            if edges[bucket] < edges[bucket + 1]:
                yield bucket, keys[edges[bucket] : edges[bucket + 1]] - self.start(bucket)


def _emit(plan: Plan):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, prints in zip(batch["block"], batch["prints"]):
                keys = _keys(_variants(np.asarray(prints, dtype=np.int64).view(np.uint64), plan.ball), plan.bits)
                keys.sort()
                parts = [(bucket, block, encode(part, plan.width)) for bucket, part in plan.split(keys)]
                yield pd.DataFrame(parts, columns=["bucket", "block", "keys"])

    return gives_back(run)


def _report(plan: Plan):
    # Keys count from the bucket's start here, so that they take half the room where a bucket has at most 2 ** 32.
    kind = np.uint32 if plan.bits - plan.bucket_bits <= 32 else np.uint64

    def run(group: pd.DataFrame) -> pd.DataFrame:
        start = plan.start(group["bucket"].iloc[0])
        lists = [decode(data, plan.width).astype(kind) for data in group["keys"]]
        together = np.concatenate(lists)
        together.sort()
        twice = np.unique(together[1:][together[1:] == together[:-1]])
        del together
        found = []
        if len(twice):
            for block, keys in zip(group["block"], lists):
                at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
                own = np.unique(keys[twice[at] == keys])
                if len(own):
                    found.append((block, encode(own + start, 4)))
        return pd.DataFrame(found, columns=["block", "reported"])

    return gives_back_groups(run)


def _links(variants: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint with the first one of each of its variants, distinct pairs whose distance holds."""
    names, index = np.unique(prints, return_inverse=True)
    order = np.lexsort((index, variants))
    variant, member = variants[order], index[order]
    head = np.concatenate([[True], variant[1:] != variant[:-1]])
    first = member[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
    pairs = np.unique(first[first != member].astype(np.int64) * len(names) + member[first != member])
    low, high = names[pairs // len(names)], names[pairs % len(names)]
    near = np.bitwise_count(low ^ high) <= radius
    return low[near], high[near]


def _forest(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every linked fingerprint but the roots, and the smallest one that links join it to."""
    names, index = np.unique(np.concatenate([low, high]), return_inverse=True)
    low, high = index[: len(low)], index[len(low) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[low], root[high])
        after = root.copy()
        np.minimum.at(after, root[low], least)
        np.minimum.at(after, root[high], least)
        after = np.minimum(after, after[after])
        if np.array_equal(after, root):
            break
        root = after
    joined = root != np.arange(len(names))
    return names[joined], names[root][joined]


def _again(plan: Plan, pairs: bool):
    """Blocks with the keys reported to them: whole variants of those keys by bucket, one fingerprint per variant, and local links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for prints, reports in zip(batch["prints"], batch["reports"]):
                own = np.asarray(prints, dtype=np.int64).view(np.uint64)
                wanted = np.sort(np.concatenate([decode(data, 4) for data in reports]))
                keys = _keys(_variants(own, plan.ball), plan.bits)
                maybe = np.zeros(1 << 24, dtype=bool)
                maybe[wanted & np.uint64(0xFFFFFF)] = True
                at = np.flatnonzero(maybe[keys & np.uint64(0xFFFFFF)])
                key = keys[at]
                del keys, maybe
                near = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                at, key = at[wanted[near] == key], key[wanted[near] == key]
                source = own[at // len(plan.ball)]
                variant = source ^ plan.ball[at % len(plan.ball)]
                low, high = _links(variant, source, plan.radius)
                low, high = (low, high) if pairs else _forest(low, high)
                rows = [(-1, low.tobytes(), high.tobytes())]
                # The first member stands for all of the block: they are joined to it already.
                one = np.lexsort((source, variant))
                one = one[np.concatenate([[True], variant[one][1:] != variant[one][:-1]])]
                variant, source, bucket = variant[one], source[one], key[one] >> np.uint64(plan.bits - plan.bucket_bits)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(plan.buckets + 1))
                for k in range(plan.buckets):
                    part = order[cuts[k] : cuts[k + 1]]
                    if len(part):
                        rows.append((k, variant[part].tobytes(), source[part].tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "variants", "prints"])

    return gives_back(run)


def _meet(plan: Plan, pairs: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        variants = np.frombuffer(b"".join(group["variants"]), dtype=np.uint64)
        prints = np.frombuffer(b"".join(group["prints"]), dtype=np.uint64)
        low, high = _links(variants, prints, plan.radius)
        low, high = (low, high) if pairs else _forest(low, high)
        return pd.DataFrame({"a": low.view(np.int64), "b": high.view(np.int64)})

    return gives_back_groups(run)


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for names, roots in zip(batch["variants"], batch["prints"]):
            yield pd.DataFrame({"a": np.frombuffer(names, dtype=np.int64), "b": np.frombuffer(roots, dtype=np.int64)})


def linked_fingerprints(prints: DataFrame, radius: int = 4, bits: int = 64, pairs: bool = False, slack: int = SLACK) -> DataFrame:
    """(a, b): edges between the distinct values of ``fingerprint`` that have the same components as all pairs
    within ``radius`` bits; radius is even and at most 6, and only the lowest ``bits`` bits are ever set.

    With ``pairs`` every edge joins two fingerprints within the radius: each one and the first of each of
    its variants. Else buckets send a spanning forest, which is less.
    """
    distinct = Stored(prints.select("fingerprint").distinct(), "simhash-distinct")
    plan = Plan(distinct.df.count(), radius, bits, slack)
    blocks = Stored(
        distinct.df.groupBy(spread(F.lit("block"), F.col("fingerprint"), parts=plan.blocks).alias("block"))
        .agg(F.sort_array(F.collect_list("fingerprint")).alias("prints")), "simhash-blocks",
    )
    distinct.drop()
    spaced = blocks.df.repartition(max(plan.blocks // 2, 1), "block")
    emitted = spaced.mapInPandas(_emit(plan), "bucket int, block int, keys binary")
    reported = Stored(emitted.groupBy("bucket").applyInPandas(_report(plan), "block int, reported binary"), "simhash-reported")
    asked = blocks.df.join(reported.df.groupBy("block").agg(F.collect_list("reported").alias("reports")), "block")
    again = Stored(asked.mapInPandas(_again(plan, pairs), "bucket int, variants binary, prints binary"), "simhash-variants")
    met = again.df.filter("bucket >= 0").groupBy("bucket").applyInPandas(_meet(plan, pairs), "a long, b long")
    local = again.df.filter("bucket < 0").mapInPandas(_unpack, "a long, b long")
    return met.unionByName(local).distinct()


def near_duplicate_components(
    docs: DataFrame, width: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint and component, the smallest key reachable over links.

    Null, empty and white-space texts have fingerprint zero and are linked like any other. Repeated rows
    and rows with a null key get rows of their own; a null key is never a component's name unless
    all its keys are null. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, width, (key,), text), "simhash-prints")
    least = stored(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "simhash-least")
    edges = linked_fingerprints(prints, radius)
    classes = connected_components(edges, "simhash-classes")
    rooted = least.join(classes.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(names, "root").select("fingerprint", "component_id"), "simhash-named")
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component_id")


# Near duplicates by similarity: fingerprints find candidates, the shingle sets of each pair decide.

FINDERS = 2
FINDER_BITS = 56
# Twice as many chance meetings, and gaps of two bytes a variant instead of three up to twice as many texts.
FINDER_SLACK = 5
SIGNATURE_WORDS = 4
STANDARD_ERRORS = 4
BANDS = 32
BAND_ROWS = 6
HASHES_AT_ONCE = 2048
CHUNK_SETS = 1024
CHUNK_SHINGLES = 2_000_000
CONSTANTS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


def _remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th of several independent-looking hashes made from one."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(CONSTANTS[k])
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    return mixed ^ (mixed >> np.uint64(32))


def _majorities(hashes: np.ndarray, count: int) -> list[int]:
    found = []
    for k in range(count):
        ones = np.zeros(64, dtype=np.int64)
        for start in range(0, len(hashes), SHINGLES_AT_ONCE):
            part = _remixed(hashes[start : start + SHINGLES_AT_ONCE], k).astype(">u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        found.append(int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big"))
    return found


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """The distinct shingle hashes in rising order; none without words."""
    return np.unique(np.concatenate(list(shingle_hashes(words, width)))) if words else np.zeros(0, dtype=np.uint64)


def mark_of(shingles: np.ndarray) -> str:
    """128 bits that name a shingle set."""
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def signature(words: list[bytes], shingles: np.ndarray) -> list[int]:
    """Finder fingerprints over the distinct words, then the words of a long fingerprint over the distinct shingles."""
    if not words:
        return [0] * (FINDERS + SIGNATURE_WORDS)
    distinct = np.array([xxhash.xxh64_intdigest(word, SEED) for word in set(words)], dtype=np.uint64)
    low = (1 << FINDER_BITS) - 1
    return [value & low for value in _majorities(distinct, FINDERS)] + _majorities(shingles, SIGNATURE_WORDS)


FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(shingles: np.ndarray) -> list[int]:
    """A key per band of the set's least hashes: two sets of Jaccard similarity j share a given one with probability j ** BAND_ROWS."""
    if not len(shingles):
        return []
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), HASHES_AT_ONCE):
        part = shingles[start : start + HASHES_AT_ONCE, None] * FACTORS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    bands = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(bands)]


def _signer(width: int):
    names = [f"f{k}" for k in range(FINDERS)] + [f"s{k}" for k in range(SIGNATURE_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, sizes, bands, made = [], [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                shingles = shingle_set(words, width)
                marks.append(mark_of(shingles))
                sizes.append(len(shingles))
                bands.append(band_keys(shingles))
                made.append(signature(words, shingles))
            table = np.array(made, dtype=np.uint64).reshape(-1, len(names))
            columns = [pa.array(np.ascontiguousarray(table[:, k]).view(np.int64)) for k in range(len(names))]
            front = [batch.column(0), pa.array(marks, pa.string()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*front, *columns], names=["id", "mark", "size", "bands", *names])

    return gives_back(run)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(words_of(text.as_py()), width) for text in batch.column(0)]
            columns = [pa.array([mark_of(one) for one in made], pa.string()), pa.array([one.tobytes() for one in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["mark", "shingles"])

    return gives_back(run)


def distance_for(similarity: float) -> int:
    """Differing bits of the long signature expected at a Jaccard similarity, plus four standard errors.

    Sets of equal size with Jaccard similarity j have cosine 2 j / (1 + j); a bit differs with probability angle / pi.
    """
    bits = 64 * SIGNATURE_WORDS
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * p + STANDARD_ERRORS * np.sqrt(bits * p * (1 - p)))


def similar_links(sets: list[np.ndarray], similarity: float, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of sets of exactly this Jaccard similarity or more that join what all such pairs would.

    With ``side`` only pairs of one set of side 0 and one of side 1 are looked at. A pair that links
    have joined already is not compared again.
    """
    sizes = np.array([len(one) for one in sets], dtype=np.int64)
    least, whole = round(similarity * 1_000_000), 1_000_000
    names, index = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(index, np.cumsum(sizes)[:-1])
    held, root, links = np.zeros(len(names), dtype=np.int64), np.arange(len(sets)), []
    for i in range(len(sets)) if side is None else np.flatnonzero(side == 0).tolist():
        open_ = root != root[i]
        open_ &= (np.minimum(sizes, sizes[i]) * whole >= least * np.maximum(sizes, sizes[i])) & (sizes > 0)
        if side is None:
            open_[:i] = False
        else:
            open_ &= side == 1
        others = np.flatnonzero(open_)
        if not len(others):
            continue
        held[codes[i]] = 1
        starts = np.cumsum(sizes[others]) - sizes[others]
        both = np.add.reduceat(held[np.concatenate([codes[j] for j in others.tolist()])], starts)
        held[codes[i]] = 0
        for j in others[both * whole >= least * (sizes[others] + sizes[i] - both)].tolist():
            if root[j] != root[i]:
                links.append((i, j))
                root[root == root[j]] = root[i]
    return links


def _verify(similarity: float):
    """Links inside the tiles of a bucket; a tile holds the members of one chunk of a group or of two."""

    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        found = []
        bucket = bucket.sort_values(["key", "low", "high", "least"], kind="stable")
        columns = [bucket[name].to_numpy() for name in ("key", "low", "high")]
        cuts = np.flatnonzero(np.any([np.diff(column) != 0 for column in columns], axis=0)) + 1
        least, chunk, shingles = bucket["least"].to_numpy(), bucket["chunk"].to_numpy(), bucket["shingles"].tolist()
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
            low, high = columns[1][start], columns[2][start]
            side = None if low == high else (chunk[start:end] == high).astype(np.int64)
            sets = [np.frombuffer(data, dtype=np.uint64) for data in shingles[start:end]]
            found += [(least[start + i], least[start + j]) for i, j in similar_links(sets, similarity, side)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return gives_back_groups(run)


def verified_links(source: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, similarity: float) -> DataFrame:
    """(a, b): ids whose shingle sets have the similarity, enough of them to join what all such pairs within a group would.

    ``groups`` has (key, mark): the nodes that share a key. Groups of equal members count once. A large one is dealt
    into chunks, and every pair of chunks is a tile of its own, so no pair of a group goes unchecked and no task gets
    more than some tiles. Only the links that join something leave a tile. The sets of the members are written once.
    """
    held = stored(groups.join(nodes.select("mark", "least", "size"), "mark"), "similar-groups")
    print_of = F.sum(F.xxhash64("mark").cast("decimal(38,0)")).alias("members")
    sizes = held.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("volume"), print_of).filter("n > 1")
    once = sizes.groupBy("n", "volume", "members").agg(F.min("key").alias("key"))
    parts = F.greatest(F.ceil(F.col("n") / CHUNK_SETS), F.ceil(F.col("volume") / CHUNK_SHINGLES)).cast("int")
    once = once.select("key", parts.alias("parts"))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "mark"), F.col("parts")).cast("int")
    member = stored(held.join(once, "key").withColumn("chunk", chunk), "similar-members")
    total = member.agg(F.sum(F.col("size") * F.col("parts"))).first()[0] or 0
    buckets = max(12, -(-int(total) // CHUNK_SHINGLES))
    wanted = member.select("mark", "least").distinct()
    ids = wanted.select(F.col("least").alias("id")).distinct()
    texts = maybe_among("id", source, ids).filter("meant").join(ids, "id", "left_semi").select("text")
    made = texts.mapInArrow(_sets(width), "mark string, shingles binary")
    sets = stored(made.join(wanted, "mark", "left_semi").dropDuplicates(["mark"]), "similar-sets")
    other = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = other.select(
        "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "mark", "least"
    ).withColumn("bucket", spread("key", "low", "high", parts=buckets))
    return tiles.join(sets, "mark").groupBy("bucket").applyInPandas(_verify(similarity), "a long, b long")


def similar_components(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, component) of the ids that have a near duplicate, and the smallest id of their group.

    Candidates come from ball hashing of two fingerprints over the distinct words, which stay
    near when a few words change, if a long signature over the ``width``-word shingles does not exclude them. There a text is
    held against one representative of its fingerprint or variant only, so the texts that share a band key of their shingles' least
    hashes are candidates too, all of them with each other; a pair of ``similarity`` 0.8 shares none of the keys once in
    some 16,000 cases. A pair counts if the Jaccard similarity of its sets of shingles is exactly ``similarity`` or more. Rows with a null id are left out.
    """
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")
    finders, words = [f"f{k}" for k in range(FINDERS)], [f"s{k}" for k in range(SIGNATURE_WORDS)]
    kinds = ["id long", "mark string", "size long", "bands array<long>", *[f"{name} long" for name in [*finders, *words]]]
    signed = stored(source.mapInArrow(_signer(width), ", ".join(kinds)), "similar-signatures")
    # Texts with one set of shingles are one node.
    least = signed.groupBy("mark").agg(F.min(F.struct("id", "size", "bands", *finders, *words)).alias("n"))
    nodes = stored(least.select("mark", F.col("n.id").alias("least"), "n.size", "n.bands", *[f"n.{name}" for name in [*finders, *words]]), "similar-nodes")
    copies = signed.join(nodes.select("mark", "least"), "mark").filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    print_of = F.struct(*words).alias("s")
    pairs = None
    for finder in finders:
        held = nodes.select(F.col(finder).alias("fingerprint"), F.col("least").alias("id"), "mark", print_of)
        first = stored(held.groupBy("fingerprint").agg(F.min(F.struct("id", "mark", "s")).alias("first")), "similar-first")
        linked = linked_fingerprints(held, radius, FINDER_BITS, pairs=True, slack=FINDER_SLACK)
        same = held.join(first, "fingerprint").filter(F.col("mark") != F.col("first.mark")).select(
            F.col("first").alias("a"), F.struct("id", "mark", "s").alias("b")
        )
        across = linked.join(first.select(F.col("fingerprint").alias("a"), F.col("first").alias("left")), "a").join(
            first.select(F.col("fingerprint").alias("b"), F.col("first").alias("right")), "b"
        ).select(F.col("left").alias("a"), F.col("right").alias("b"))
        far = sum((F.bit_count(F.col(f"a.s.{word}").bitwiseXOR(F.col(f"b.s.{word}"))) for word in words), F.lit(0))
        kept = same.unionByName(across).filter(far <= distance_for(similarity)).select(F.col("a.mark").alias("a"), F.col("b.mark").alias("b"))
        pairs = kept if pairs is None else pairs.unionByName(kept)
    groups = pairs.distinct().select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("mark"))
    groups = groups.unionByName(nodes.select(F.explode("bands").alias("key"), "mark"))
    found = copies.unionByName(verified_links(source, nodes, groups, width, similarity))
    return connected_components(found, "similar-classes").select(F.col("node").alias("id"), "component")


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each group of near duplicates only.

    Rows with a null id are kept, as are all rows without a near duplicate. Rows that repeat an id share its fate.
    """
    groups = stored(similar_components(docs, width, similarity, key=key, text=text), "similar-groups")
    return without_ids(docs, key, groups.filter("id <> component").select("id"))
