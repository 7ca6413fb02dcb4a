"""Whether documents of any size are one JSON value: a check that is put together from pieces of the files.

A document too large for one text value is read as the pieces between its commas, by as many tasks as Spark cuts the file into.
What a piece does to the reader's state depends on whether it begins inside a string, so both cases are noted: the change of the bracket depth,
the lowest depth on the way and what follows the last bracket; and whether the piece leaves the string state turned over. These
notes compose: states are carried over the pieces of each block of a file, and over its blocks, by running sums. Then a document is
one value exactly if its depth is never zero between its first bracket and its last, which is followed by white space only.

What stands inside the brackets is not judged here; the scan's parser does that and marks the document if it is malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .. import files
from ..functions.paths import decoded_path
from ..session import opening_paths

NONE = 1 << 40


def _walk(brackets: Column) -> Column:
    """Depth change and lowest depth along a text of brackets."""
    start = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(NONE).alias("least"))

    def step(state: Column, bracket: Column) -> Column:
        depth = state["depth"] + F.when(bracket.isin("[", "{"), 1).when(bracket.isin("]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(bracket == "", state["least"]).otherwise(F.least(state["least"], depth)).alias("least"))

    return F.aggregate(F.split(brackets, ""), start, step)


def _outside(cuts: Column, first: int) -> Column:
    """What a piece does outside of strings, of its parts between quotes those from ``first`` on by twos."""
    text = F.array_join(F.filter(cuts, lambda part, i: i % 2 == first), '"')
    brackets = F.regexp_replace(text, r"[^\[\]{}]", "")
    whole, before = _walk(brackets), _walk(F.substring(brackets, F.lit(1), F.length(brackets) - 1))
    blank = F.regexp_extract(text, r"([^\[\]{}]*)\z", 1).rlike(r"^[ \t\r\n]*\z")
    return F.struct(
        whole["depth"].alias("change"), whole["least"].alias("least"), F.when(F.length(brackets) > 0, before["least"]).otherwise(F.lit(-NONE)).alias("before"),
        blank.alias("blank"),
    )


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    with opening_paths(spark):
        text = spark.read.option("recursiveFileLookup", True).option("lineSep", ",").text([files.literal_path(path) for path in paths])
    cuts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    return text.select(
        decoded_path(F.col("_metadata.file_path")).alias("path_part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), F.octet_length("value").cast("long").alias("bytes"), F.col("_metadata.file_size").alias("file_bytes"), ((F.size(cuts) - 1) % 2).alias("turns"),
        _outside(cuts, 0).alias("out"), _outside(cuts, 1).alias("inside"),
        F.col("value").rlike(r"^\s*[\[{]").alias("opens"), F.col("value").rlike(r"^\s*\[\s*\]\s*\z").alias("blank_list"),
    )


def check_structure(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path_part, state) of every file that is not blank: ``ok``, ``empty`` (an empty list) or ``error``."""
    in_block = W.partitionBy("path_part", "block").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turns").over(in_block), F.lit(0)) % 2
    pieces = _pieces(spark, paths).withColumn("turned", turned)
    # A block's own changes, for a start outside of a string and for one inside.
    blocks = pieces.groupBy("path_part", "block").agg(
        F.sum(F.when(F.col("turned") == 0, F.col("out.change")).otherwise(F.col("inside.change"))).alias("from_out"),
        F.sum(F.when(F.col("turned") == 0, F.col("inside.change")).otherwise(F.col("out.change"))).alias("from_inside"),
        (F.sum("turns") % 2).alias("block_turns"), F.max("nth").alias("last_nth"), F.min("nth").alias("first_nth"),
    )
    in_file = W.partitionBy("path_part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("path_part")
    begun = blocks.withColumn("starts_inside", F.coalesce(F.sum("block_turns").over(in_file), F.lit(0)) % 2)
    begun = begun.withColumn("change", F.when(F.col("starts_inside") == 0, F.col("from_out")).otherwise(F.col("from_inside")))
    begun = begun.select(
        "path_part", "block", "starts_inside", F.coalesce(F.sum("change").over(in_file), F.lit(0)).alias("block_depth"),
        F.when(F.col("block") == F.max("block").over(whole), F.col("last_nth")).alias("end_nth"),
        F.when(F.col("block") == F.min("block").over(whole), F.col("first_nth")).alias("start_nth"),
        ((F.sum("block_turns").over(whole) % 2) == 1).alias("open_string"),
    )
    placed = pieces.join(begun, ["path_part", "block"])
    is_inside = (F.col("starts_inside") + F.col("turned")) % 2 == 1
    own = placed.withColumn("own", F.when(is_inside, F.col("inside")).otherwise(F.col("out")))
    depth = F.col("block_depth") + F.coalesce(F.sum("own.change").over(in_block), F.lit(0))
    own = own.withColumn("depth", depth)
    first, last = F.coalesce(F.col("nth") == F.col("start_nth"), F.lit(False)), F.coalesce(F.col("nth") == F.col("end_nth"), F.lit(False))
    lowest = F.when(last, F.col("own.before")).otherwise(F.col("own.least"))
    fits = (F.when(first, F.col("opens")).otherwise(F.col("depth") >= 1)) & (F.col("depth") + lowest >= 1)
    fits = fits & (~last | ((F.col("depth") + F.col("own.change") == 0) & F.col("own.blank") & ~F.col("open_string")))
    found = own.groupBy("path_part").agg(F.min(fits).alias("fits"), F.min("blank_list").alias("blank_list"), F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bytes"), F.max("file_bytes").alias("file_bytes"))
    # A comma at the very end begins no piece; the sizes tell of it (3 bytes less where the reader takes off a byte order mark).
    comma_last = (F.col("file_bytes") - F.col("bytes") - F.col("n")).isin(0, 3)
    state = F.when(comma_last, "error").when(F.col("blank_list") & (F.col("n") == 1), "empty").when(F.col("fits"), "ok").otherwise("error")
    return found.select("path_part", state.alias("state"))
