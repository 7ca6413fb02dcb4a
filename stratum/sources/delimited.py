"""CSV files: header names, column types and the scan.

Any number of files is looked at together: one scan of their lines finds each file's header, one parse the kinds of its columns,
its rows and its widest row. Files of one layout are then read by one scan. No job is started for a single file.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import files
from ..functions.paths import decoded_path
from ..operators.columns import quoted
from ..operators.rows import concat_vertical
from ..session import open_many, opening_paths, shared_dir
from ..sinks.parquet import write_table

CORRUPT = "__corrupt"

# Texts that mean "no value" in a CSV cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
INFINITE = r"(?i)^\s*[+-]?inf(?:inity)?\s*$"
# A cell and the comma behind it.
CELL = r'("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*),'
QUOTED_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+"'

CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "maxCharsPerColumn": "-1",
}

# Where files have more widths than this they are parsed by classes of width, each twice as wide as the last, so that one wide file
# does not make every parse wide.
FEW_WIDTHS = 6
NARROWEST = 16
MANY_COLUMNS = 256

# A row over several lines may hold more cells than the fullest line; the parser has places for so many.
SPARE_CELLS = 1 << 16


class RaggedCsvError(ValueError):
    """A row holds more cells than the header allows."""


@dataclass(frozen=True)
class CsvLayout:
    """What files read by one scan have in common: column names and kinds, and how many unnamed cells stand before them."""

    names: tuple[str, ...]
    unnamed: int
    kinds: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.names) + self.unnamed

    @property
    def types(self) -> list[str]:
        return [_column_type(kind) for kind in self.kinds]


def _reader(spark: SparkSession, multiline: bool, width: int):
    return spark.read.options(**CSV_OPTIONS).option("maxColumns", 2 * width + SPARE_CELLS).option("multiLine", multiline)


def _cells(width: int) -> list[T.StructField]:
    return [T.StructField(f"c{i}", T.StringType()) for i in range(width)]


def header_names(cells: list[str | None]) -> list[str]:
    """Blank names become ``Unnamed: i``; a repeated name gets the first free ``.1``, ``.2``, .."""
    names = [cell if cell else f"Unnamed: {i}" for i, cell in enumerate(cells)]
    taken, result = set(names), []
    for name in names:
        unique, i = name, 0
        while unique in result:
            i += 1
            if f"{name}.{i}" not in taken:
                unique = f"{name}.{i}"
        taken.add(unique)
        result.append(unique)
    return result


def split_cells(record: Column) -> Column:
    """The cells of one record's text, quotes resolved; none has a missing value's null."""
    raw = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(CELL), F.lit(1))
    return F.transform(raw, lambda cell: F.when(
        cell.startswith('"'), F.replace(F.regexp_replace(cell, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(cell))


def _open(spark: SparkSession, paths: list[str], width: int, multiline: bool, header: bool = True) -> DataFrame:
    """The first ``width`` cells of every row that is not blank, its text where it has another number of cells, its file's URI and its place there."""
    schema = T.StructType([*_cells(width), T.StructField(CORRUPT, T.StringType())])
    with opening_paths(spark):
        reader = _reader(spark, multiline, width).schema(schema).option("header", header)
        rows = open_many(reader, "csv", [files.literal_path(p) for p in paths])
    # A scan numbers its rows in the order of each block of a file.
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = rows.select("*", F.col("_metadata.file_path").alias("uri"), place.alias("place"))
    space = F.lit(" \t\r\n")
    # White space alone on a line is no row. The first cell keeps a data column in every scan:
    # Spark refuses to read the marker alone.
    blank = F.trim(F.coalesce("c0", F.lit("" if width > 1 else "-")), space) == ""
    if width > 1:
        blank = blank & (F.trim(F.coalesce(CORRUPT, F.lit("-")), space) == "")
    return rows.where(~blank)


def _n_cells(width: int) -> Column:
    """Cells of a row; the marker holds the text of short and of long rows."""
    unquoted = F.regexp_replace(F.col(CORRUPT), QUOTED_CELL, "$1q")
    return F.when(F.col(CORRUPT).isNull(), width).otherwise(F.size(F.split(unquoted, ",")))


def _value(i: int) -> Column:
    return F.when(~F.col(f"c{i}").isin(*NA_TOKENS), F.col(f"c{i}"))


def _headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path_part, header, cells): each file's first line that is not empty, and how many cells its fullest line may hold."""
    with opening_paths(spark):
        lines = open_many(spark.read.option("recursiveFileLookup", True), "text", [files.literal_path(p) for p in paths])
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    cells = F.length("value") - F.length(F.replace("value", F.lit(","))) + 1
    lines = lines.select("value", F.col("_metadata.file_path").alias("uri"), place.alias("place"), cells.alias("cells"))
    found = lines.where("value <> ''").groupBy("uri").agg(F.min_by("value", "place").alias("header"), F.max("cells").alias("cells"))
    return found.select(decoded_path(F.col("uri")).alias("path_part"), "header", "cells")


def _kinds(spark: SparkSession, paths: list[str], width: int, multiline: bool) -> DataFrame:
    """Per file what the rows below its header are like, by position."""
    rows = _open(spark, paths, width, multiline).withColumn("n_cells", _n_cells(width))
    counts = [F.count(F.lit(1)).alias("n_rows"), F.min_by("n_cells", "place").alias("first"), F.max("n_cells").alias("most")]
    if width <= MANY_COLUMNS:
        kinds = [F.bit_or(_cell_kind(_value(i))).alias(f"k{i}") for i in range(width)]
        found = rows.groupBy("uri").agg(*counts, *kinds).withColumn("kinds", F.array(*[f"k{i}" for i in range(width)]))
    else:
        # One expression for all columns; a plan with thousands of aggregates takes longer than the data.
        cells = F.transform(F.array(*[f"c{i}" for i in range(width)]), lambda cell: _cell_kind(F.when(~cell.isin(*NA_TOKENS), cell)))
        by_place = rows.select("uri", F.posexplode(cells).alias("pos", "kind")).groupBy("uri", "pos").agg(F.bit_or("kind").alias("kind"))
        kinds = by_place.groupBy("uri").agg(F.sort_array(F.collect_list(F.struct("pos", "kind"))).getField("kind").alias("kinds"))
        found = rows.groupBy("uri").agg(*counts).join(kinds, "uri")
    return found.select(decoded_path(F.col("uri")).alias("path_part"), "n_rows", "first", "most", F.lit(width).alias("width"), "kinds")


class _Paths(dict):
    """Paths by their part without scheme; a file below a folder that was named has the folder's scheme."""

    def __missing__(self, part: str) -> str:
        above = part
        while "/" in above[1:]:
            above = above.rsplit("/", 1)[0]
            if above in self:
                return self[above].rstrip("/") + part[len(above):]
        return part


def _by_width(paths: dict[int, list[str]]) -> dict[int, list[str]]:
    """Files by the width they are parsed with: their own where few widths occur, as a row of another number of cells costs several times as much."""
    if len(paths) <= FEW_WIDTHS:
        classes = {width: max(2, width) for width in paths}
    else:
        classes = {width: max(NARROWEST, 1 << (width - 1).bit_length()) for width in paths}
    by_class: dict[int, list[str]] = {}
    for width, some in paths.items():
        by_class.setdefault(classes[width], []).extend(some)
    return by_class


def survey(spark: SparkSession, paths: list[str], scratch: str, multiline: bool = True) -> DataFrame:
    """(path_part, names, n_rows, unnamed, too_long, kinds) of every file with a line that is not empty, stored below ``scratch``.

    ``names`` are the header's cells, ``kinds`` bit sets per column. A first data row wider than the header has leading
    unnamed cells; ``too_long`` says that a row holds more cells than both allow, or that the header is blank. The number of jobs does not depend on the number of files.
    """
    by_part = _Paths({files.plain_part(spark, path): path for path in paths})
    write_table(_headers(spark, paths), f"{scratch}/headers")
    headers = spark.read.parquet(f"{scratch}/headers")
    open_quote = F.length(F.regexp_replace("header", '[^"]', "")) % 2 == 1
    widths: dict[int, list[str]] = {}
    broken = []
    for part, cells, is_open in headers.select("path_part", "cells", open_quote).toLocalIterator():
        widths.setdefault(int(cells), []).append(by_part[part])
        if is_open:
            broken.append(by_part[part])
    if broken and multiline:
        # A header over several lines: with one column, the marker of any wider row is its whole text.
        first = _open(spark, broken, 1, True, header=False).groupBy("uri").agg(F.min_by(F.coalesce(CORRUPT, "c0"), "place").alias("whole"))
        first = first.select(decoded_path(F.col("uri")).alias("path_part"), "whole")
        headers = headers.join(first, "path_part", "left").withColumn("header", F.coalesce("whole", "header")).drop("whole")
    rounds = []
    while widths:
        made = f"{scratch}/kinds-{len(rounds)}"
        write_table(concat_vertical(*[_kinds(spark, some, width, multiline) for width, some in sorted(_by_width(widths).items())]), made)
        rounds.append(spark.read.parquet(made))
        # A row over several lines may be wider than any of its lines: once more, by its own width.
        widths = {}
        for part, most in rounds[-1].where("most > width").select("path_part", "most").toLocalIterator():
            widths.setdefault(most, []).append(by_part[part])
    kinds = concat_vertical(*[found.where("most <= width") for found in rounds]) if rounds else None
    if kinds is None:
        kinds = spark.createDataFrame([], "path_part string, n_rows bigint, first int, most int, width int, kinds array<int>")
    names = split_cells(F.col("header"))
    found = headers.select("path_part", "header", names.alias("names")).join(kinds, "path_part", "left")
    n = F.size("names")
    unnamed = F.greatest(F.lit(0), F.coalesce("first", F.lit(0)) - n)
    # Null kinds at the end: a header wider than all rows, or no row at all.
    padded = F.concat(F.coalesce("kinds", F.array().cast("array<int>")), F.array_repeat(F.lit(0), n))
    table = found.withColumn("unnamed", unnamed).select(
        "path_part", "names", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "unnamed",
        ((F.coalesce("most", F.lit(0)) > n + F.col("unnamed")) | (F.trim("header") == "")).alias("too_long"),
        F.transform(F.slice(padded, F.col("unnamed") + 1, n), lambda kind: F.coalesce(kind, F.lit(0))).alias("kinds"),
    )
    write_table(table, f"{scratch}/survey")
    return spark.read.parquet(f"{scratch}/survey")


def _boolean(cell: Column) -> Column:
    return F.when(cell.isin(*TRUE_TOKENS), F.lit(True)).when(cell.isin(*FALSE_TOKENS), F.lit(False))


# One bit per kind of cell.
NEGATIVE, NATURAL, UNSIGNED, FLOATING, FLAG, TEXT = (1 << i for i in range(6))


def _cell_kind(cell: Column) -> Column:
    """Kind of one cell. Patterns decide; casts, slow where they fail, only see long integers."""
    number = F.trim(cell)
    beyond = number.try_cast("decimal(20,0)").between(F.lit(0), F.lit(Decimal(2**64 - 1)))
    whole = (
        F.when((F.length(cell) > 18) & number.try_cast("bigint").isNull(), F.when(beyond, UNSIGNED).otherwise(TEXT))
        .when(cell.contains("-"), NEGATIVE)
        .otherwise(NATURAL)
    )
    # From the colon on in the code table there are letters: true, false, inf or no number at all.
    wordy = F.when(cell.isin(*TRUE_TOKENS, *FALSE_TOKENS), FLAG).when(cell.rlike(INFINITE), FLOATING).otherwise(TEXT)
    return (
        F.when(cell.isNull(), 0)
        .when(cell >= ":", wordy)
        .when(cell.rlike(INTEGER), whole)
        .when(cell.rlike(NUMBER), FLOATING)
        .when(cell.rlike(INFINITE), FLOATING)
        .otherwise(TEXT)
    )


def _column_type(kinds: int | None) -> str:
    for kind, allowed in (
        ("bigint", NEGATIVE | NATURAL), ("decimal(20,0)", NATURAL | UNSIGNED),
        ("double", NEGATIVE | NATURAL | FLOATING), ("boolean", FLAG),
    ):
        if kinds and not kinds & ~allowed:
            return kind
    return "string"


def _typed(cell: Column, kind: str) -> Column:
    if kind == "string":
        return cell
    return _boolean(cell) if kind == "boolean" else F.trim(cell).cast(kind)


def layout_of(names: list[str], unnamed: int, kinds: list[int]) -> CsvLayout:
    return CsvLayout(tuple(header_names(names)), unnamed, tuple(kinds))


def layout_table(spark: SparkSession, paths: list[str], layout: CsvLayout, multiline: bool = True) -> DataFrame:
    """The typed rows of files of one layout, and ``path_part``, their file; one scan."""
    rows = _open(spark, paths, layout.width, multiline)
    columns = [
        _typed(_value(i + layout.unnamed), kind).alias(name)
        for i, (name, kind) in enumerate(zip(layout.names, layout.types, strict=True))
    ]
    return rows.select(*columns, decoded_path(F.col("uri")).alias("path_part"))


def scan_csv(spark: SparkSession, paths: list[str], multiline: bool = True) -> tuple[DataFrame, int]:
    """Typed frame of CSV files with the same columns, in whatever order each has them, and its number of rows.

    Values go by each file's own header. Dates stay text. A row with surplus cells rejects the whole input; a short row is filled
    with nulls. ``multiline=False`` lets Spark split large files, for data without line breaks inside quotes.
    """
    seen = survey(spark, paths, shared_dir(spark, "csv"), multiline)
    by_part = _Paths({files.plain_part(spark, path): path for path in paths})
    rows = {row.path_part: row for row in seen.toLocalIterator()}
    missing = [path for part, path in by_part.items() if not any(name == part or name.startswith(f"{part}/") for name in rows)]
    if missing:
        raise RaggedCsvError(f"no columns in {', '.join(missing)}")
    layouts: dict[CsvLayout, list[str]] = {}
    for part in sorted(rows, key=lambda part: list(by_part).index(part) if part in by_part else 0):
        row = rows[part]
        if row.too_long:
            raise RaggedCsvError(f"a row of {by_part[part]} holds more cells than the header and the first row")
        layouts.setdefault(layout_of(row.names, row.unnamed, row.kinds), []).append(by_part[part])
    first = next(iter(layouts))
    kinds = dict.fromkeys(first.names, 0)
    for layout in layouts:
        if set(layout.names) != set(first.names):
            raise RaggedCsvError(f"columns {', '.join(layout.names)} in {layouts[layout][0]}, {', '.join(first.names)} in {layouts[first][0]}")
        kinds = {name: kinds[name] | kind for name, kind in zip(layout.names, layout.kinds, strict=True)}
    tables = [
        layout_table(spark, some, CsvLayout(layout.names, layout.unnamed, tuple(kinds[name] for name in layout.names)), multiline).select(*[quoted(name) for name in first.names])
        for layout, some in layouts.items()
    ]
    return concat_vertical(*tables), sum(row.n_rows for row in rows.values())


def read_csv(spark: SparkSession, paths: str | list[str], multiline: bool = True) -> DataFrame:
    return scan_csv(spark, [paths] if isinstance(paths, str) else list(paths), multiline)[0]
