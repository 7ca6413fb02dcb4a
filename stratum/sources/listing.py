"""File listing as a DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import files
from ..functions.paths import decoded_path, relative_path, without_extension

LISTING_SCHEMA = "file_key string, path string, src_mtime timestamp, length bigint"

# Listing reads no bytes. These settings keep Spark from cutting the listing into one task per
# 128 MB of files it will never open.
LISTING_CONF = {"spark__sql__files__maxPartitionBytes": str(2**50)}


def _glob_regex(pattern: str) -> str:
    out = ""
    for piece in re.split(r"(\*\*/|\*|\?|\[[^\]]*\])", pattern):
        if piece == "**/":
            out += "(?:.*/)?"
        elif piece == "*":
            out += "[^/]*"
        elif piece == "?":
            out += "[^/]"
        elif piece.startswith("[") and piece.endswith("]"):
            out += piece.replace("[!", "[^")
        else:
            out += re.escape(piece)
    return f"^{out}$"


def _is_single(pattern: str) -> bool:
    return not re.search(r"[*?\[]", pattern)


def open_folder(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """File scan over the matching names; its file index is the one listing of the folder."""
    start = f"{root}/{pattern}" if _is_single(pattern) else root
    if not files.exists(spark, start):
        return None
    reader = spark.read.format("binaryFile")
    if not _is_single(pattern):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern.rsplit("/", 1)[-1])
    return reader.load(files.literal_path(start))


def list_files(spark: SparkSession, root: str, pattern: str = "*", found: DataFrame | None = None) -> DataFrame:
    """Files below ``root`` whose relative path matches ``pattern``; a missing root lists nothing.

    ``file_key`` is the relative path without the extension that ``pattern`` ends in, so equal names
    in two directories, or with two extensions, stay two files. Like every Spark scan it passes over files without content; see
    ``zero_byte_files``. ``found`` is the opened folder, if there is one already.
    """
    root = root.rstrip("/")
    found = found if found is not None else open_folder(spark, root, pattern)
    if found is None:
        return spark.createDataFrame([], LISTING_SCHEMA)
    relative = relative_path(F.col("_metadata.file_path"), files.path_part(spark, root))
    listed = found.select(
        without_extension(relative, pattern).alias("file_key"),
        "path",
        F.col("_metadata.file_modification_time").alias("src_mtime"),
        F.col("_metadata.file_size").alias("length"),
        relative.alias("relative"),
    )
    if not _is_single(pattern):
        listed = listed.where(F.col("relative").rlike(_glob_regex(pattern)))
    return listed.drop("relative")


# Folders below the root in which names that Spark hides are looked for, where a pattern leaves the depth open.
HIDDEN_DEPTH = 6


def hidden_files(spark: SparkSession, root: str, pattern: str) -> DataFrame | None:
    """Files that the pattern selects but Spark's readers pass over, as their names begin with ``_`` or ``.``; None if there are none.

    They cannot be read and are reported every time, as files without content are. Only patterns that end in an extension are
    looked at, so that markers and check sums of writers are no landing files. Only such names reach the driver.
    """
    extension = re.search(r"\.[A-Za-z0-9]+$", pattern)
    if not extension:
        return None
    root = root.rstrip("/")
    folders = [pattern.rsplit("/", 1)[0] + "/" if "/" in pattern else ""]
    while any("**/" in folder for folder in folders):
        folders = [folder.replace("**/", "*/" * depth, 1) for folder in folders for depth in range(HIDDEN_DEPTH if "**/" in folder else 1)]
    below = files.path_part(spark, root)
    matches, seen = re.compile(_glob_regex(pattern)), []
    for folder in sorted(set(folders)):
        for path, stamp in files.glob(spark, f"{files.literal_path(root)}/{folder}[_.]*{extension[0]}"):
            relative = path[len(below) + 1:]
            if matches.match(relative):
                seen.append((relative, f"{root}/{relative}", stamp))
    if not seen:
        return None
    found = spark.createDataFrame(sorted(set(seen)), "relative string, path string, stamp double")
    return found.select(
        without_extension(F.col("relative"), pattern).alias("file_key"), "path", F.timestamp_seconds("stamp").alias("src_mtime"),
        F.lit(0).cast("bigint").alias("length"),
    )


def zero_byte_files(
    spark: SparkSession, root: str, pattern: str, found: DataFrame | None, listed: DataFrame
) -> DataFrame | None:
    """The matching files that ``listed``, a stored listing, leaves out because they are empty.

    None when the file index holds no more names than were listed, which is the usual case.
    Such a file can never be read, so it counts as changed just now and is reported every time.
    """
    root = root.rstrip("/")
    names = found._jdf.inputFiles() if found is not None else []
    if len(names) <= listed.count():
        return None
    jvm = spark._jvm
    uris = spark._jsparkSession.createDataset(
        jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(names), jvm.org.apache.spark.sql.Encoders.STRING()
    )
    relative = relative_path(F.col("value"), files.path_part(spark, root))
    matching = F.lit(True) if _is_single(pattern) else relative.rlike(_glob_regex(pattern))
    rest = DataFrame(uris.toDF(), spark).where(matching).select(
        without_extension(relative, pattern).alias("file_key"),
        decoded_path(F.col("value")).alias("path"),
        F.current_timestamp().alias("src_mtime"),
        F.lit(0).cast("bigint").alias("length"),
    )
    return rest.join(listed, "file_key", "left_anti")
