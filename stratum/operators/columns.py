"""Column operators. All of them are one ``select`` that Catalyst folds into the scan."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.paths import capture_int

OBJECT_PART = "object_part"
SCALAR_PART = "scalar_part"


class ColumnCollisionError(ValueError):
    """Two input columns would get the same output name."""


def quoted(*parts: str) -> Column:
    """Column by exact name, or by a path of field names."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in parts))


def _leaves(value: Column, name: str, kind: T.DataType, metadata: dict) -> list[tuple[str, Column]]:
    if isinstance(kind, T.StructType):
        return [
            leaf
            for field in kind.fields
            for leaf in _leaves(value.getField(field.name), f"{name}.{field.name}", field.dataType, field.metadata)
        ]
    if isinstance(kind, T.VariantType) and OBJECT_PART in metadata:
        return _mixed_leaves(value, name, metadata)
    return [(name, value)]


def _mixed_leaves(value: Column, name: str, metadata: dict) -> list[tuple[str, Column]]:
    """Columns of a field that holds an object in some records and another value in others."""
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    fields = T.StructType.fromJson(metadata[OBJECT_PART])
    columns = []
    if fields.fields:
        parts = F.when(is_object, F.try_variant_get(value, "$", fields.simpleString()))
        columns += _leaves(parts, name, fields, {})
    if metadata[SCALAR_PART]:
        columns.append((name, F.when(~is_object, F.try_variant_get(value, "$", metadata[SCALAR_PART]))))
    return columns


def flat_columns(schema: T.StructType) -> list[tuple[str, Column]]:
    """Dotted name and expression of every leaf; arrays are leaves."""
    return [
        leaf
        for field in schema.fields
        for leaf in _leaves(quoted(field.name), field.name, field.dataType, field.metadata)
    ]


def check_names(schema: T.StructType) -> None:
    """Raise if the flat form of ``schema`` would hold two columns of one name."""
    normalized_names([name for name, _ in flat_columns(schema)])


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested structs to dotted top-level columns at any depth; absent parents give null."""
    return df.select(*[value.alias(name) for name, value in flat_columns(df.schema)])


def normalized_names(names: list[str]) -> list[str]:
    """Replace dots by underscores; names that then differ by case only are a collision."""
    seen = defaultdict(list)
    for name in names:
        seen[name.replace(".", "_").lower()].append(name)
    clashes = [group for group in seen.values() if len(group) > 1]
    if clashes:
        listed = "; ".join(", ".join(repr(name) for name in group) for group in clashes)
        raise ColumnCollisionError(f"columns would share one name: {listed}")
    return [name.replace(".", "_") for name in names]


def normalize_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*normalized_names(df.columns))


def lists_as_text(schema: T.StructType) -> T.StructType:
    """Declare top-level lists as string, so that the scan keeps their JSON text as it stands."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), f.nullable, f.metadata) if isinstance(f.dataType, T.ArrayType) else f
            for f in schema.fields
        ]
    )


def serialize_lists(df: DataFrame) -> DataFrame:
    """JSON text for top-level array columns of a frame that is already parsed."""
    keep_nulls = {"ignoreNullFields": "false"}
    return df.select(
        *[
            F.to_json(quoted(f.name), keep_nulls).alias(f.name) if isinstance(f.dataType, T.ArrayType) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.when(~F.isnan(quoted(f.name)), quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[quoted(name) for name in columns])


def with_file_value(df: DataFrame, name: str, path: Column, pattern: str) -> DataFrame:
    """Add the number that ``pattern`` captures from each row's file path."""
    return df.withColumn(name, capture_int(path, pattern))
