"""Sources and sinks: CSV files, JDBC, catalog tables."""

from strata.sources.files import read_csv, source_file_column, with_audit, write_csv
from strata.sources.jdbc import derby_memory_url, read_jdbc, seed_from_files, write_jdbc
from strata.sources.tables import (append_run, append_table, compact_runs, ensure_namespaces,
                                   list_namespaces, list_tables, read_table, replace_table, table_exists,
                                   write_partitioned)

__all__ = [
    "append_run", "append_table", "compact_runs", "derby_memory_url", "ensure_namespaces", "list_namespaces", "list_tables",
    "read_csv", "read_jdbc", "read_table", "replace_table", "seed_from_files",
    "source_file_column", "table_exists", "with_audit", "write_csv", "write_jdbc",
    "write_partitioned",
]
