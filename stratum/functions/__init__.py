from .documents import document_state, is_single_document
from .paths import capture_int, decoded_path, file_stem, output_name, relative_path, without_extension

__all__ = [
    "capture_int", "decoded_path", "document_state", "file_stem", "is_single_document",
    "output_name", "relative_path", "without_extension",
]
