from .columns import (
    ColumnCollisionError, flat_columns, flatten_structs, lists_as_text, nan_to_null,
    normalize_column_names, normalized_names, project, serialize_lists, with_file_value,
)
from .freshness import freshness_plan, is_source_newer
from .rows import concat_vertical, head_by, require_rows, shape, tail_by, unique_by
from .summary import batch_summary

__all__ = [
    "ColumnCollisionError", "batch_summary", "concat_vertical", "flat_columns", "flatten_structs",
    "freshness_plan", "head_by", "is_source_newer", "lists_as_text", "nan_to_null",
    "normalize_column_names", "normalized_names", "project", "require_rows", "serialize_lists",
    "shape", "tail_by", "unique_by", "with_file_value",
]
