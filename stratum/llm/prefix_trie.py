"""The trie of conversation prefixes: every distinct sequence of first turns is a node.

1. *Order.* Turns become slim rows (conversation, digest of role and text, words), are dealt out by range of conversation and
   turn and numbered within each piece, pieces then by their offsets: a conversation of a third of all rows is split over many
   tasks.
2. *Names.* A prefix is named by the exclusive or of the 128-bit hashes of its (position, digest) pairs, taken over pieces of
   a conversation and then across them. Two prefixes share a name if they are the same sequence; two different ones do with a
   probability of 2^-128 each.
3. *Nodes.* One hash aggregate over fixed-width values, reduced before its shuffle.
4. *Totals.* Parallel tree contraction (``contraction``): rake and compress rounds, then re-expansion.
5. *Ends.* Ids that end in a node are sorted by range, joined to blocks of text by many tasks, and only the blocks of a
   node meet in one stream that feeds its SHA-256, which is sequential by definition; no list of them is ever held.

Order: by turn (null first), ties by the turn's digest. Null role or text count as empty. Rows with a null conversation belong
to no conversation and are left out. Repeated rows are turns of their own. Texts of any length are hashed whole. An empty table
has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .contraction import NODE, subtree_totals
from .scratch import Stored, numbered

PIECE_TURNS = 65_536
BLOCK_IDS = 4_096
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, digest, words): a slim row per turn; the digest names role and text together."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.length(by).cast("string"), F.concat(by, said)).cast("binary"), 256)
    return conversations.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.unhex(digest).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    ).filter("conv is not null")


def positions(turns: DataFrame) -> DataFrame:
    """(conv, pos, digest, words) with positions from 1, by range so that no conversation is one task's."""
    slim = numbered(turns, "trie-turns")
    sorted_ = slim.repartitionByRange(F.col("conv"), F.col("turn"), F.col("digest"), F.col("__row_id")).withColumn("piece", F.spark_partition_id())
    dealt = Stored(sorted_, "trie-dealt").df
    within = W.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first(), "digest", "__row_id")
    sizes = dealt.groupBy("conv", "piece").agg(F.count("*").alias("n"))
    before = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("conv", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = dealt.withColumn("nth", F.row_number().over(within)).join(offsets, ["conv", "piece"])
    return ranked.select("conv", (F.col("offset") + F.col("nth")).alias("pos"), "digest", "words")


def spliced(turns: DataFrame, conv_base: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv) and turns (conv, pos, digest, words) after each took its first turns from another.

    ``turns`` has positions. With h = ``taken`` (a column of conv, at most ``most``), the first h turns of conversation
    ``conv_base`` (all if it has fewer, none if it is absent) come before the conversation's own turns after its first h.
    """
    convs = Stored(turns.groupBy("conv").agg(F.max("pos").alias("n")).select("conv", "n", conv_base.alias("base"), taken.cast("long").alias("h")), "trie-convs").df
    heads = turns.filter(F.col("pos") <= most).withColumnRenamed("conv", "base")
    copied = convs.filter("h > 0").select("conv", "base", "h").join(heads, "base").filter("pos <= h").select("conv", "pos", "digest", "words")
    # Only a base shorter than h moves the own turns; few conversations have one.
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    moved = convs.filter("h > 0 and n > h").join(bases, "base", "left").select(
        "conv", (F.least(F.coalesce("n_base", F.lit(0)), "h") - F.col("h")).alias("shift")).filter("shift <> 0")
    own = turns.filter(F.col("pos") > taken).join(moved, "conv", "left").select(
        "conv", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "digest", "words")
    return convs.select("conv"), copied.unionByName(own)


def _names(turns: DataFrame) -> DataFrame:
    """(conv, pos, words, a, b, pa, pb): the names of each prefix and of the one before it."""
    marked = turns.select(
        "conv", "pos", "words", F.floor((F.col("pos") - 1) / PIECE_TURNS).cast("long").alias("piece"),
        F.xxhash64(F.lit(1), "pos", "digest").alias("x"), F.xxhash64(F.lit(2), "pos", "digest").alias("y"),
    )
    sums = marked.groupBy("conv", "piece").agg(F.bit_xor("x").alias("sx"), F.bit_xor("y").alias("sy"))
    before = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    late = sums.select("conv", "piece", F.bit_xor("sx").over(before).alias("bx"), F.bit_xor("sy").over(before).alias("by")).filter("piece > 0")
    upto = W.partitionBy("conv", "piece").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    run = marked.withColumn("a", F.bit_xor("x").over(upto)).withColumn("b", F.bit_xor("y").over(upto)).join(late, ["conv", "piece"], "left")
    full = run.withColumn("a", F.col("a").bitwiseXOR(F.coalesce("bx", F.lit(0)))).withColumn("b", F.col("b").bitwiseXOR(F.coalesce("by", F.lit(0))))
    return full.select("conv", "pos", "words", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"))


def _blocks(most: int):
    """Sorted (a, b, conv) to blocks (a, b, first, ids) of at most ``most`` ids of one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, node, ids = [], None, []
        for batch in batches:
            for a, b, conv in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                if (a, b) != node or len(ids) == most:
                    if ids:
                        out.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (a, b), []
                ids.append(conv)
            if len(out) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=["a", "b", "first", "ids"])
                out = []
        if ids:
            out.append((*node, ids[0], ",".join(map(str, ids))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=["a", "b", "first", "ids"])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks to one digest a node; only the hash state is held."""
    out, node, state = [], None, None
    for batch in batches:
        for a, b, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 3)]):
            if (a, b) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=["a", "b", "ends_sha256"])
            out = []
    if node is not None:
        out.append((*node, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names=["a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of (a, b, conv): the SHA-256 of each node's ids, rising and comma-joined."""
    keys = [F.col(name) for name in ("a", "b", "conv")]
    blocks = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_blocks(BLOCK_IDS), "a long, b long, first long, ids string")
    return blocks.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digests, "a long, b long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations ``convs`` (conv) with ``turns`` (conv, pos, digest, words).

    Columns: a, b (the node's name), depth, conv_id (smallest member), parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, what the members' copies of each turn but one take) and ends_sha256.
    """
    named = Stored(_names(turns), "trie-prefixes").df
    groups = named.groupBy("a", "b").agg(
        F.min("conv").alias("conv_id"), F.max("pos").alias("depth"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"),
    )
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs",
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
    )
    plain = Stored(groups.unionByName(root), "trie-plain").df
    kids = plain.filter("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = Stored(plain.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes").df
    weighed = nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    totals = subtree_totals(weighed, ["leaves", "saved"])
    # A conversation ends in its last prefix, one without turns in the root.
    last = named.groupBy("conv").agg(F.max("pos").alias("pos"))
    ended = named.join(last, ["conv", "pos"]).select("a", "b", "conv")
    none = convs.join(last, "conv", "left_anti").select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv")
    digests = end_digests(ended.unionByName(none))
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(totals, NODE).join(digests, NODE, "left").join(above, ["pa", "pb"], "left").select(
        *NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("total_leaves").alias("n_leaves"),
        F.col("total_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
