"""Consistent-hash ring with virtual nodes and bounded loads.

Keys fall on a ring of hash bins, every bin on the next virtual node clockwise. A shard takes bins
until its bytes reach the bound of ``1 + slack`` times the mean; what is left continues
clockwise to the next virtual node of a shard that is not full, round after round. So no
shard is above the bound by more than its last bin, whatever the keys and sizes are, and
adding a shard moves about the share that it takes over.

The walk works on bins (at most ``bins`` plus the pieces of hot ones), not on rows, and its size
does not grow with the input. A bin far above the mean, as of one key with a third of all
rows, is split by row id.

Defined results: a null text has size 1 and checksum 0; a null key is a key like any other;
repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import ROW_ID, Stored, numbered, spread, stored, text_or_empty

RING = 1 << 32
MOST_PIECES = 4096


def ring_points(spark, shards: int, vnodes: int) -> DataFrame:
    """(pos, shard): the virtual nodes; adding a shard adds its nodes and moves no other."""
    points = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
    return points.select(F.pmod(F.xxhash64(F.lit("ring"), "shard", "v"), F.lit(RING)).alias("pos"), "shard")


def _offers(waiting: DataFrame, open_points: DataFrame) -> DataFrame:
    """Each waiting unit with the shard of the next open virtual node clockwise."""
    none = F.lit(None)
    both = waiting.select("bin", "sub", "size", "pos", none.cast("int").alias("point")).unionByName(open_points.select(
        none.cast("int").alias("bin"), none.cast("int").alias("sub"), none.cast("long").alias("size"), "pos",
        F.col("shard").alias("point"),
    ))
    # Bounded by bins and virtual nodes, so one task may hold it. Past the last node the first one follows.
    ahead = W.orderBy(F.desc("pos"), F.desc(F.col("point").isNotNull()), F.desc("point")).rowsBetween(W.unboundedPreceding, W.currentRow)
    wrap = open_points.agg(F.min(F.struct("pos", "shard")).alias("first")).first()["first"]["shard"]
    offer = F.coalesce(F.last("point", ignorenulls=True).over(ahead), F.lit(wrap))
    return both.withColumn("offer", offer).filter("bin is not null").drop("point")


def place(units: DataFrame, shards: int, vnodes: int, bound: float) -> DataFrame:
    """Units (bin, sub, size, pos) with the shard that takes each, in rounds around the ring.

    A shard takes large units first and closes at the first one beyond the bound. Every round
    places all units or closes a shard. When all are closed, those below the bound open
    once more and take units as long as they are below it, so all units find a place.
    """
    points = ring_points(units.sparkSession, shards, vnodes)
    placed: list[DataFrame] = []
    load = dict.fromkeys(range(shards), 0)
    closed: set[int] = set()
    fits = True
    waiting = Stored(units, "ring-units")
    left = waiting.df.count()
    while left:
        if len(closed) == shards:
            fits = False
        full = [shard for shard in range(shards) if (shard in closed if fits else load[shard] >= bound)]
        open_points = points.filter(~F.col("shard").isin(full)) if full else points
        before = F.element_at(F.array(*[F.lit(load[shard]).cast("long") for shard in range(shards)]), F.col("offer") + 1)
        order = W.partitionBy("offer").orderBy(F.desc("size"), "bin", "sub").rowsBetween(W.unboundedPreceding, W.currentRow)
        after = F.sum("size").over(order) + before
        taken = (after <= F.lit(bound)) if fits else (after - F.col("size") < F.lit(bound))
        done = stored(_offers(waiting.df, open_points).withColumn("taken", taken), "ring-round")
        placed.append(done.filter("taken").select("bin", "sub", F.col("offer").alias("shard")))
        for row in done.groupBy("offer").agg(F.sum(F.when(F.col("taken"), F.col("size"))).alias("took"), F.min("taken").alias("all")).collect():
            load[row["offer"]] += row["took"] or 0
            if not row["all"]:
                closed.add(row["offer"])
        waiting.drop()
        waiting = Stored(done.filter("not taken").select("bin", "sub", "size", "pos"), "ring-units")
        left = waiting.df.count()
    if not placed:
        return units.select("bin", "sub", F.lit(None).cast("int").alias("shard"))
    result = placed[0]
    for part in placed[1:]:
        result = result.unionByName(part)
    return result


def shard_rows(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", vnodes: int = 64, bins: int = 1 << 15,
    slack: float = 0.002, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per row of ``docs``: the kept columns, size, text_crc32, shard and slot (gapless from 0 in each shard).

    The text is read once, for its size and checksum; only numbers are shuffled after that,
    once by bin for the shard and once by bin for the slot.
    """
    body = text_or_empty(text)
    slim = numbered(docs.select(
        *[F.col(name) for name in dict.fromkeys((*keep, key))],
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        spread(F.lit("key"), F.col(key), parts=bins).alias("bin"),
    ), "shard-rows")
    total, count = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    # A bin above four times the mean, and above a thousandth of a shard, is cut into pieces of that size.
    grain = max(4 * total // bins, total // (1000 * shards), 1)
    per_bin = slim.groupBy("bin").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
        "bin", F.least(F.ceil(F.col("bytes") / grain), "n", F.lit(MOST_PIECES)).cast("int").alias("pieces")
    )
    cut = stored(per_bin, "shard-bins")
    whole = slim.join(cut, "bin").withColumn("sub", F.pmod(F.xxhash64(F.lit("piece"), F.col(ROW_ID)), F.col("pieces")).cast("int"))
    rows = stored(whole.drop("pieces"), "shard-pieces")
    step = RING // bins
    sums = rows.groupBy("bin", "sub").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    units = stored(sums.withColumn("pos", (F.col("bin").cast("long") * step)), "shard-units")
    placed = place(units.drop("n"), shards, vnodes, (1 + slack) * total / shards)
    before = W.partitionBy("shard").orderBy("bin", "sub").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.join(units.select("bin", "sub", "n"), ["bin", "sub"]).select(
        "bin", "sub", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    rank = F.row_number().over(W.partitionBy("bin", "sub").orderBy(ROW_ID)) - 1
    return rows.withColumn("rank", rank).join(starts, ["bin", "sub"]).select(
        *keep, "size", "text_crc32", "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot")
    )
