"""Column functions on file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def decoded_path(uri: Column) -> Column:
    """Path of a ``_metadata.file_path`` URI: percent codes resolved, scheme and host removed."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")


def relative_path(uri: Column, root: str) -> Column:
    """Part of the path below ``root`` (given without scheme, see ``files.path_part``)."""
    return F.substring(decoded_path(uri), len(root.rstrip("/")) + 2, 2**31 - 1)


def without_extension(path: Column, pattern: str) -> Column:
    """Path without the extension in which ``pattern`` ends.

    A pattern that leaves the extension open keeps it, so two files never share one name.
    """
    extension = re.search(r"\.[A-Za-z0-9]+$", pattern)
    return F.regexp_replace(path, f"\\{extension[0]}$", "") if extension else path


def file_stem(path: Column) -> Column:
    """File name without directories and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def output_name(key: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(f"{prefix}_"), key) if prefix else key


def capture_int(text: Column, pattern: str) -> Column:
    """First group of ``pattern`` as bigint; null where the pattern does not match."""
    return F.regexp_extract(text, pattern, 1).try_cast("bigint")
