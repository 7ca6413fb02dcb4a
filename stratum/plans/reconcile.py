"""Bring the schemas of several file batches and the known schema of a dataset together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import types as T

from ..operators.schema import merge_schemas, without_fields

TEXT_LIKE = (T.StringType(), T.ArrayType(T.StringType()))

# Second look at a batch: its schema and the doubtful field names in, a corrected schema out.
SecondLook = Callable[[T.StructType, list[str]], T.StructType]


def _named(schema: T.StructType, above: str = "") -> Iterator[tuple[str, T.DataType]]:
    for field in schema.fields:
        name = f"{above}{field.name}"
        yield name, field.dataType
        if isinstance(field.dataType, T.StructType):
            yield from _named(field.dataType, f"{name}.")


def field_names(schema: T.StructType) -> set[str]:
    return {name for name, _ in _named(schema)}


def text_like_names(schema: T.StructType) -> set[str]:
    return {name for name, kind in _named(schema) if kind in TEXT_LIKE}


def reconcile(
    known: T.StructType | None, unseen: set[str], batches: list[tuple[T.StructType, SecondLook]]
) -> T.StructType:
    """One schema for all.

    Inference calls a field string when it never has a value, and also when its values are of
    several kinds. Where another batch knows a type for such a field, the batch is looked at
    again before the type is given up.
    """
    schemas = [schema for schema, _ in batches] + ([known] if known else [])
    typed = {name for schema in schemas for name, kind in _named(schema) if kind not in TEXT_LIKE}
    merged = without_fields(known, unseen & typed) if known else T.StructType([])
    for schema, second_look in batches:
        doubtful = text_like_names(schema) & typed
        if doubtful:
            schema = second_look(schema, sorted(doubtful))
        merged = merge_schemas(merged, schema)
    return merged
