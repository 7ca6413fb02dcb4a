from .parquet import drop_partitions, finish_replacement, write_partitions, write_pending, write_table

__all__ = ["drop_partitions", "finish_replacement", "write_partitions", "write_pending", "write_table"]
