"""Driver-side file system calls, through the Hadoop client Spark already uses."""

from __future__ import annotations

import os
import re
import shutil
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_GLOB_CHARS = re.compile(r"([\[\]{}*?\\])")

# Calls at a time, for many folders in a store.
CALLS = 16


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def move_uri(spark: SparkSession, uri: str, to: str) -> None:
    """Rename what a percent-encoded URI names, over a file that has the new name; folders on the way are made."""
    fs, target = _open(spark, to)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)), target):
        raise OSError(f"could not rename {uri} to {to}")


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, over one that has the new name; folders on the way are made."""
    fs, target = _open(spark, to)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(_open(spark, path)[1], target):
        raise OSError(f"could not rename {path} to {to}")


def move_all(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """``move`` for many folders; on a disk by the system's own call, 0.03 ms each instead of some 4 by way of Spark's client."""
    for batch in _portions(moves):
        here = mounted_path(spark, batch[0][0]) and mounted_path(spark, batch[0][1])
        if not here:
            with ThreadPoolExecutor(CALLS) as pool:
                list(pool.map(lambda pair: move(spark, *pair), batch))
            continue
        for path, to in batch:
            path, to = plain_part(spark, path), plain_part(spark, to)
            _make_way(to)
            os.rename(path, to)


def copy_all(spark: SparkSession, path: str, targets: Iterable[str]) -> None:
    """Copies of one small folder, each over the folder that has its name."""

    def put(to: str) -> None:
        delete(spark, to)
        copy(spark, path, to)

    for batch in _portions(targets):
        if not (mounted_path(spark, path) and mounted_path(spark, batch[0])):
            with ThreadPoolExecutor(CALLS) as pool:
                list(pool.map(put, batch))
            continue
        for to in batch:
            to = plain_part(spark, to)
            _make_way(to)
            shutil.copytree(plain_part(spark, path), to, copy_function=shutil.copyfile)


def _portions(items: Iterable) -> Iterable[list]:
    portion = []
    for item in items:
        portion.append(item)
        if len(portion) == 10_000:
            yield portion
            portion = []
    if portion:
        yield portion


def _make_way(path: str) -> None:
    """On a disk: nothing is left under the name, and the folders on the way are there."""
    if os.path.isdir(path):
        shutil.rmtree(path)
    elif os.path.exists(path):
        os.remove(path)
    else:
        os.makedirs(os.path.dirname(path), exist_ok=True)


def unescaped(name: str) -> str:
    """The value that a partition folder's name stands for."""
    return re.sub("%([0-9A-Fa-f]{2})", lambda code: chr(int(code[1], 16)), name)


def copy(spark: SparkSession, path: str, to: str) -> None:
    """Copy a folder of a bounded number of files."""
    fs, source = _open(spark, path)
    target = _open(spark, to)[1]
    fs.mkdirs(target.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, target, False, spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, over one that is there."""
    fs, target = _open(spark, path)
    with_stream = fs.create(target, True)
    with_stream.write(bytearray(text.encode()))
    with_stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that must not exist yet; False if another run was first.

    File systems without an atomic creation may let two runs through; reading the text back tells them apart.
    """
    fs, target = _open(spark, path)
    try:
        stream = fs.create(target, False)
        stream.write(bytearray(text.encode()))
        stream.close()
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return read_text(spark, path) == text


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; empty if it is gone."""
    fs, target = _open(spark, path)
    try:
        stream = fs.open(target)
    except Py4JJavaError:
        return ""
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths without scheme that a pattern names, and the seconds of their last change; folders are left out."""
    fs, target = _open(spark, pattern)
    found = fs.globStatus(target)
    return [(status.getPath().toUri().getPath(), status.getModificationTime() / 1000) for status in found or [] if status.isFile()]


def stamps(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder and the seconds of their last change."""
    fs, target = _open(spark, path)
    return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in fs.listStatus(target)]


def delete_uri(spark: SparkSession, uri: str) -> None:
    """Delete what a percent-encoded URI, as in ``_metadata.file_path``, names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def has_partitions(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return any("=" in status.getPath().getName() for status in fs.listStatus(target))


def children(spark: SparkSession, path: str) -> list[str]:
    return [f"{path.rstrip('/')}/{name}" for name in names(spark, path)]


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, without the files that the client hides, its check sums."""
    here = mounted_path(spark, path)
    if here:
        return [name for name in os.listdir(here) if not (name.startswith(".") and name.endswith(".crc"))]
    fs, target = _open(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def path_part(spark: SparkSession, path: str) -> str:
    """Absolute path without scheme and host, as it appears inside file URIs."""
    fs, target = _open(spark, path)
    return fs.makeQualified(target).toUri().getPath()


def plain_part(spark: SparkSession, path: str) -> str:
    """As ``path_part``, without asking the file system where the path is absolute."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "", path)
    return plain if plain.startswith("/") and "//" not in plain and not plain.endswith("/") else path_part(spark, path)


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """Where tasks find a path on a disk of their own machine; None in a store that only Spark reaches."""
    fs, target = _open(spark, path)
    return fs.makeQualified(target).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def literal_path(path: str) -> str:
    """Escape glob characters so that the readers take a path as it is."""
    return _GLOB_CHARS.sub(r"\\\1", path)
