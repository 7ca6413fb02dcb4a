from .delimited import read_csv, scan_csv
from .documents import CORRUPT, SOURCE_PATH, check_documents, infer_documents, mixed_fields, open_texts, read_documents, scan_documents
from .listing import list_files, open_folder, zero_byte_files
from .tables import parquet_glob, parquet_table

__all__ = [
    "CORRUPT", "SOURCE_PATH", "check_documents", "infer_documents", "list_files", "mixed_fields", "open_folder",
    "open_texts", "parquet_glob", "parquet_table", "read_csv", "read_documents", "scan_csv", "scan_documents",
    "zero_byte_files",
]
