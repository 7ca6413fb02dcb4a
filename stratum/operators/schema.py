"""One schema per dataset: merging what a new batch of files shows into what is known."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, types as T

from .columns import OBJECT_PART, SCALAR_PART, quoted


def field_at(name: str, schema: T.StructType) -> Column:
    """Column of a dotted field name, where field names themselves may hold dots."""
    for path in leaf_paths(schema):
        if ".".join(path) == name:
            return quoted(*path)
    raise KeyError(name)


def leaf_paths(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        path = (*above, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaf_paths(field.dataType, path)
        else:
            yield path


def without_paths(schema: T.StructType, paths: set[tuple[str, ...]], above: tuple[str, ...] = ()) -> T.StructType:
    """``schema`` without the leaves of ``paths``; a struct that held nothing else goes too."""
    kept = []
    for field in schema.fields:
        path = (*above, field.name)
        if isinstance(field.dataType, T.StructType):
            inner = without_paths(field.dataType, paths, path)
            if inner.fields or not field.dataType.fields:
                kept.append(T.StructField(field.name, inner, field.nullable, field.metadata))
        elif path not in paths:
            kept.append(field)
    return T.StructType(kept)


def name_clashes(paths: set[tuple[str, ...]], reserved: set[str]) -> list[list[tuple[str, ...]]]:
    """Groups of leaves whose flat names are one name, or a name that is ``reserved``."""
    groups: dict[str, list[tuple[str, ...]]] = {}
    for path in sorted(paths):
        groups.setdefault(".".join(path).replace(".", "_").lower(), []).append(path)
    return [group for name, group in groups.items() if len(group) > 1 or name in reserved]


def pick_fields(schema: T.StructType, types: dict[str, T.DataType], above: str = "") -> T.StructType:
    """The part of ``schema`` that holds the dotted names of ``types``, with those types."""
    kept = []
    for field in schema.fields:
        name = f"{above}{field.name}"
        if name in types:
            kept.append(T.StructField(field.name, types[name]))
        elif isinstance(field.dataType, T.StructType):
            inner = pick_fields(field.dataType, types, f"{name}.")
            if inner.fields:
                kept.append(T.StructField(field.name, inner))
    return T.StructType(kept)


def with_mixed(schema: T.StructType, mixed: dict[str, dict], above: str = "") -> T.StructType:
    """Declare the fields of ``mixed`` as variant, noting the types of their two sides."""
    fields = []
    for field in schema.fields:
        name = f"{above}{field.name}"
        if name in mixed:
            field = T.StructField(field.name, T.VariantType(), True, mixed[name])
        elif isinstance(field.dataType, T.StructType):
            field = T.StructField(field.name, with_mixed(field.dataType, mixed, f"{name}."), True, field.metadata)
        fields.append(field)
    return T.StructType(fields)


def is_mixed(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.VariantType) and OBJECT_PART in field.metadata


def widen(known: T.DataType, seen: T.DataType) -> T.DataType:
    """The narrowest type that holds both; the rules of Spark's own JSON inference."""
    if known == seen:
        return known
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        return merge_schemas(known, seen)
    if isinstance(known, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(widen(known.elementType, seen.elementType))
    whole = (T.LongType, T.DecimalType)
    if isinstance(known, whole) and isinstance(seen, whole):
        digits = max(19 if isinstance(k, T.LongType) else k.precision for k in (known, seen))
        return T.DecimalType(digits, 0)
    numeric = (T.LongType, T.DecimalType, T.DoubleType)
    if isinstance(known, numeric) and isinstance(seen, numeric):
        return T.DoubleType()
    return T.StringType()


def _merge_field(known: T.StructField, seen: T.StructField) -> T.StructField:
    objects = [k for k in (known, seen) if isinstance(k.dataType, T.StructType)]
    if not (is_mixed(known) or is_mixed(seen) or len(objects) == 1):
        return T.StructField(known.name, widen(known.dataType, seen.dataType), True, known.metadata)
    fields, scalar = T.StructType([]), ""
    for side in (known, seen):
        if is_mixed(side):
            object_part, scalar_part = T.StructType.fromJson(side.metadata[OBJECT_PART]), side.metadata[SCALAR_PART]
        elif isinstance(side.dataType, T.StructType):
            object_part, scalar_part = side.dataType, ""
        else:
            text = isinstance(side.dataType, T.ArrayType)
            object_part, scalar_part = T.StructType([]), "string" if text else side.dataType.simpleString()
        fields = merge_schemas(fields, object_part)
        if scalar and scalar_part:
            scalar = widen(T.DataType.fromDDL(scalar), T.DataType.fromDDL(scalar_part)).simpleString()
        scalar = scalar or scalar_part
    return T.StructField(known.name, T.VariantType(), True, {OBJECT_PART: fields.jsonValue(), SCALAR_PART: scalar})


def merge_schemas(known: T.StructType, seen: T.StructType) -> T.StructType:
    """Union of the fields by exact name; a struct that meets a scalar becomes a mixed field."""
    by_name = {field.name: field for field in seen.fields}
    merged = [_merge_field(f, by_name.pop(f.name)) if f.name in by_name else f for f in known.fields]
    return T.StructType([*merged, *by_name.values()])


def without_fields(schema: T.StructType, names: set[str], above: str = "") -> T.StructType:
    kept = []
    for field in schema.fields:
        name = f"{above}{field.name}"
        if isinstance(field.dataType, T.StructType):
            inner = without_fields(field.dataType, names, f"{name}.")
            if inner.fields:
                kept.append(T.StructField(field.name, inner, True, field.metadata))
        elif name not in names:
            kept.append(field)
    return T.StructType(kept)
