"""Tables written between steps, in the shared folder named by ``spark.checkpoint.dir``.

A written table cuts the lineage: a lost executor costs the tasks that read it, never the
work before it. Each helper of a loop drops the tables that no later step reads.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.files import delete
from stratum.session import session_conf, shared_dir

ROW_ID = "__row_id"
# Of rows that go to Python at once: 10,000 texts would be some 20 MB, which a task holds several times over, here and in the executor.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession):
    """Settings under which rows go to Python by ``BATCH_BYTES``, for what is not written but collected."""
    return session_conf(spark, spark__sql__execution__arrow__maxBytesPerBatch=BATCH_BYTES)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table that is known to be so only when it is read, so what is made from it stays the plan of a full one.

    An empty list given to ``createDataFrame`` goes through RDDs, for which every executor starts a second Python, with processes of its own, and keeps it.
    """
    fields = StructType.fromDDL(schema).fields
    none = spark.range(0, 1, 1, 1).filter("id < 0")
    return none.select(*[F.col("id").cast("string").cast(field.dataType).alias(field.name) for field in fields])


class Stored:
    """A written table: ``df`` reads it, ``drop()`` deletes it when nothing reads it any more."""

    def __init__(self, df: DataFrame, label: str):
        self.spark: SparkSession = df.sparkSession
        self.path = shared_dir(self.spark, label)
        with small_batches(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def give_back() -> None:
    """Returns the room that this process no longer uses to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gives_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which its Python process, which Spark keeps for later tasks, returns the room it no longer uses.

    Else an executor holds the largest batch of every past step for each of its cores.
    """

    @wraps(run)
    def task(parts: Iterator) -> Iterator:
        yield from run(parts)
        give_back()

    return task


def gives_back_groups(run: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """``run`` of one group, after each of which its Python process returns the room that it no longer uses."""

    @wraps(run)
    def task(group):
        out = run(group)
        give_back()
        return out

    return task


def stored(df: DataFrame, label: str) -> DataFrame:
    return Stored(df, label).df


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` written with a unique row id.

    The id tells repeated rows apart and is the same in every later read, which an id
    computed anew in each job would not be.
    """
    return stored(df.withColumn(ROW_ID, F.monotonically_increasing_id()), label)


def spread(*columns: Column, parts: int) -> Column:
    """A group number from 0 to ``parts - 1`` by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


def _pieces(places: DataFrame) -> DataFrame:
    """(piece, bits): a bit map in pieces of 4 KB; bit ``place`` is set for every row of the only column."""
    place = F.col(places.columns[0]) + 1
    pieces = places.select(F.bitmap_bucket_number(place).alias("piece"), F.bitmap_bit_position(place).alias("bit"))
    return pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits"))


# Bits of a map of ids: 2 MB, whatever the number of ids.
ID_BITS = 1 << 24


def maybe_among(key: str, rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with a boolean column ``meant``: false where ``key`` is null or certainly not in the only column of ``ids``.

    A bit map of fixed size is broadcast, so rows that cannot be meant, with their texts, need no shuffle to find that out.
    """
    held = ids.select(F.col(ids.columns[0]).alias("id")).filter("id is not null").select(F.pmod(F.xxhash64("id"), F.lit(ID_BITS)).alias("place"))
    pieces = _pieces(held).select(F.col("piece").alias("__piece"), F.col("bits").alias("__bits"))
    marked = rows.withColumn("__place", F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(ID_BITS)) + 1))
    joined = marked.join(F.broadcast(pieces), F.bitmap_bucket_number("__place") == F.col("__piece"), "left")
    at = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2))
    return joined.withColumn("meant", F.coalesce(bit == 1, F.lit(False))).drop("__place", "__piece", "__bits")


def wrapped(rows: DataFrame) -> Column:
    """All columns as one, so that no name can clash with one of a helper's own; ``row.*`` gives them back."""
    return F.struct(*[F.col(f"`{name}`") for name in rows.columns]).alias("row")


def without_ids(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is not in the only column of ``gone``; only rows that may be meant are shuffled. Null keys stay."""
    ids = gone.select(F.col(gone.columns[0]).alias("gone"))
    marked = maybe_among("id", rows.select(wrapped(rows), F.col(f"`{key}`").cast("long").alias("id")), ids)
    doubtful = marked.filter("meant").join(ids, F.col("id") == F.col("gone"), "left_anti").select("row.*")
    return marked.filter("not meant").select("row.*").unionByName(doubtful)


def bit_map(places: DataFrame, bits: int) -> bytes:
    """A map of ``bits`` bits, a multiple of 32,768, with those set that the only column of ``places`` names.

    Its size does not depend on the table: pieces of 4 KB are made by an aggregate and put together on the driver.
    """
    out = bytearray(bits // 8)
    for row in _pieces(places).toLocalIterator():
        start = (row.piece - 1) * len(row.bits)
        out[start : start + len(row.bits)] = row.bits
    return bytes(out)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_text(column: str = "doc_id") -> Column:
    """The id as text for hash folds; a null id counts as empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
