"""Readers and writers for title tables and results."""

from playbill.sources.readers import first_columns, read_result, read_titles_csv
from playbill.sources.writers import write_partitioned, write_result, write_table

__all__ = [
    "first_columns", "read_result", "read_titles_csv",
    "write_partitioned", "write_result", "write_table",
]
