"""JSON files: checking, schema inference and the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import files
from ..functions.documents import document_state, is_single_document
from ..functions.paths import decoded_path
from ..operators.columns import (
    OBJECT_PART, SCALAR_PART, ColumnCollisionError, check_names, flatten_structs, lists_as_text, nan_to_null,
    normalize_column_names,
    quoted,
)
from ..operators.rows import concat_vertical
from ..operators.schema import field_at, pick_fields
from ..session import larger_tasks, opening_paths, session_conf, small_files

CORRUPT = "__corrupt"
SOURCE_PATH = "__path"

# A text value holds at most 2 GB; larger documents are read as a stream without the check. Files of
# lines have no such limit: their lines are the texts.
LARGEST_CHECKED_FILE = 2_000_000_000

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
    "maxStringLen": str(2**31 - 1),
}

# A control character that no valid JSON text holds: with it as the line separator, the line
# reader takes each file as one record.
WHOLE_FILE = "\x1e"


def _reader(spark: SparkSession, lines: bool, streamed: bool = False):
    """Reader for one record per line, or for whole files.

    Whole files are read as one long line each. The multi-line reader would do, but it fetches
    the text of every list that is kept as text by a positioned read of the file, one request
    per value on a remote file system; it is left for files too large for one text value.
    """
    reader = spark.read.options(**JSON_OPTIONS).option("recursiveFileLookup", True)
    if lines:
        return reader
    return reader.option("multiLine", True) if streamed else reader.option("lineSep", WHOLE_FILE)


def open_texts(spark: SparkSession, paths: list[str], lines: bool = False) -> DataFrame:
    """Text of each file, or of each line."""
    literal = [files.literal_path(p) for p in paths]
    with opening_paths(spark):
        return spark.read.option("recursiveFileLookup", True).text(literal, wholetext=not lines)


def check_documents(texts: DataFrame, lines: bool = False) -> DataFrame:
    """State (``ok``, ``empty``, ``error``) of every non-blank file, as ``path_part, state``."""
    path = decoded_path(F.col("_metadata.file_path")).alias("path_part")
    if not lines:
        return texts.select(path, document_state(F.col("value")).alias("state"))
    record = F.col("value").rlike(r"^\s*\{") & is_single_document(F.col("value"))
    verdicts = texts.where(F.trim("value") != "").select(path, record.alias("valid"))
    return verdicts.groupBy("path_part").agg(F.min("valid").alias("valid")).select(
        "path_part", F.when(F.col("valid"), "ok").otherwise("error").alias("state")
    )


def _infer(reader, paths: list[str], texts: DataFrame | None) -> T.StructType:
    if texts is None:
        return reader.json([files.literal_path(p) for p in paths]).schema
    # Over paths, multi-line inference sets up a file system client per file, which for small
    # files costs far more than the parsing; over the files' texts it does not.
    strings = getattr(texts._jdf, "as")(texts.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())
    return reader._df(reader._jreader.json(strings)).schema


def infer_documents(
    spark: SparkSession, paths: list[str], lines: bool = False, drop_null: bool = False, streamed: bool = False,
    texts: DataFrame | None = None,
) -> T.StructType:
    """One schema over all records of all files.

    ``drop_null`` leaves out fields without any value. ``streamed`` is for files too large to
    be held as one text. ``texts`` are the files as opened before.
    """
    if texts is None and not (lines or streamed):
        texts = open_texts(spark, paths)
    reader = _reader(spark, lines, streamed).option("dropFieldIfAllNull", drop_null)
    with session_conf(spark, spark__sql__caseSensitive="true"), opening_paths(spark), small_files(spark):
        try:
            schema = _infer(reader, paths, texts)
        except AnalysisException as failure:
            if failure.getCondition() == "COLUMN_ALREADY_EXISTS":
                raise ColumnCollisionError(f"a record repeats a field name: {failure}") from failure
            raise
    return T.StructType([field for field in schema.fields if field.name != CORRUPT])


def scan_documents(
    spark: SparkSession, paths: list[str], schema: T.StructType, lines: bool = False, streamed: Iterable[str] = ()
) -> DataFrame:
    """The records of all files, the corrupt marker and the source path.

    A list root gives its elements, an object root one row. A root that is no list of records
    gives one row with only the marker set. Paths in ``streamed`` name files too large to be
    held as one text; they go through the multi-line reader.
    """
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    with opening_paths(spark):
        scans = [
            _reader(spark, lines, large).schema(declared).json([files.literal_path(p) for p in some])
            for some, large in ((paths, False), (list(streamed), True))
            if some
        ]
    path = decoded_path(F.col("_metadata.file_path")).alias(SOURCE_PATH)
    return concat_vertical(*[scan.select("*", path) for scan in scans])


def flat_table(rows: DataFrame) -> DataFrame:
    """Flattened columns with normal names and without NaN."""
    check_names(rows.schema)
    return nan_to_null(normalize_column_names(flatten_structs(rows)))


def records(scan: DataFrame) -> DataFrame:
    """The flat table of the well-formed records of a scan."""
    return flat_table(scan.where(F.col(CORRUPT).isNull()).drop(CORRUPT))


def read_documents(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: T.StructType | str | None = None,
    lists_to_text: bool = True,
    lines: bool = False,
    path_column: str | None = None,
    malformed: str = "drop",
) -> DataFrame:
    """Flat table of a set of JSON files or directories, for direct use without a manifest.

    A file that cannot be parsed, or does not fit a given schema, gives no rows (with ``lines``: a
    line); ``malformed="raise"`` fails with its path instead. The rows do not depend on the columns
    that are used later: under a given schema every column of a record is parsed. ``path_column`` names a
    column for each row's source path.
    """
    if malformed not in ("drop", "raise"):
        raise ValueError(f"malformed must be drop or raise, not {malformed!r}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    # An inferred schema fits every record, so what is malformed does not depend on the columns read.
    fits = schema is None and malformed == "drop"
    if schema is None:
        schema = infer_documents(spark, paths, lines)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    declared = lists_as_text(schema) if lists_to_text else schema
    marker = [] if fits else [T.StructField(CORRUPT, T.StringType())]
    with opening_paths(spark):
        reader = _reader(spark, lines).schema(T.StructType([*declared.fields, *marker]))
        reader = reader.option("mode", "DROPMALFORMED") if fits else reader
        rows = reader.json([files.literal_path(p) for p in paths])
    path = decoded_path(F.col("_metadata.file_path"))
    names = [quoted(field.name) for field in declared.fields]
    if not fits:
        # Naming all columns where a record is malformed keeps them in the scan, at no cost for the others.
        content = F.to_json(F.struct(*names)) if names else F.lit("")
        if malformed == "raise":
            reject = F.raise_error(F.concat(F.lit("malformed record in "), path, F.lit(": "), F.left(content, F.lit(200)))).cast("boolean")
        else:
            reject = F.length(content) < 0
        rows = rows.where(F.when(F.col(CORRUPT).isNotNull(), reject).otherwise(True))
    return flat_table(larger_tasks(rows.select(*names, *([path.alias(path_column)] if path_column else []))))


def mixed_fields(
    spark: SparkSession, paths: list[str], schema: T.StructType, names: list[str], lines: bool = False,
    streamed: Iterable[str] = (),
) -> dict[str, dict]:
    """Which of the dotted ``names`` hold objects in some records, and the types of both sides.

    Inference reports such a field as string, and so does a string whose content looks like an
    object. Reading the field as variant tells them apart.
    """
    probe = pick_fields(schema, {name: T.VariantType() for name in names})
    scan = scan_documents(spark, paths, probe, lines, streamed)
    measures = []
    for i, name in enumerate(names):
        value = field_at(name, probe)
        shape = F.schema_of_variant(value)
        is_object = shape.startswith("OBJECT")
        measures += [
            F.max(is_object).alias(f"any{i}"),
            F.schema_of_variant_agg(F.when(is_object, value)).alias(f"object{i}"),
            F.schema_of_variant_agg(F.when(~is_object, value)).alias(f"scalar{i}"),
        ]
    found = scan.where(F.col(CORRUPT).isNull()).agg(*measures).first()
    return {
        name: {
            OBJECT_PART: _spark_type(found[f"object{i}"]).jsonValue(),
            SCALAR_PART: _scalar_name(found[f"scalar{i}"]),
        }
        for i, name in enumerate(names)
        if found[f"any{i}"]
    }


def _as_inferred(kind: T.DataType) -> T.DataType:
    """The type the JSON reader would have inferred for a variant schema."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_inferred(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_inferred(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.LongType() if kind.precision <= 18 else kind
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def _spark_type(shape: str) -> T.StructType:
    if shape in ("OBJECT<>", "VOID"):
        return T.StructType([])
    return _as_inferred(T.DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")))


def _scalar_name(shape: str) -> str:
    """DDL name of the other side's type; empty when only objects and nulls occur."""
    if shape == "VOID":
        return ""
    kind = _as_inferred(T.DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")))
    return "string" if isinstance(kind, (T.ArrayType, T.StructType)) else kind.simpleString()
