"""Row operators: concatenation, distinct, ordering, counting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def concat_vertical(*frames: DataFrame) -> DataFrame:
    """Append frames of equal columns, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def unique_by(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate rather than a ranking window: each task reduces its rows to one per key
    before the shuffle, so a key that owns a third of the rows sends one row per task.
    """
    first = [name for name in order or [] if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in first]
    if not first + rest:
        return df.dropDuplicates(keys)
    chosen = df.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("chosen"))
    return chosen.select(*[name if name in keys else F.col("chosen")[name].alias(name) for name in df.columns])


def head_by(df: DataFrame, order: list[Column | str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail_by(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """Last ``n`` rows by ``order``, found as the first rows of the reverse order."""
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(message)
    return df
