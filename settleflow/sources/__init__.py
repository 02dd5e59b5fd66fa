"""Sources and sinks."""

from settleflow.sources.buckets import BucketTable
from settleflow.sources.delimited import read_delimited, read_lines
from settleflow.sources.files import list_files, number_files
from settleflow.sources.records import read_records
from settleflow.sources.sinks import (
    append_by_name,
    export_parquet,
    load_by_name,
    read_route,
    truncate,
    write_delimited,
    write_groups,
    write_insert,
    write_jdbc,
    write_routes,
    write_snapshot,
)
from settleflow.sources.tables import (
    fixed_rows,
    group_table_name,
    read_all_groups,
    read_group_table,
    read_mapping,
    read_query,
    read_table,
)

__all__ = [
    "BucketTable",
    "append_by_name",
    "export_parquet",
    "fixed_rows",
    "group_table_name",
    "list_files",
    "load_by_name",
    "number_files",
    "read_all_groups",
    "read_delimited",
    "read_group_table",
    "read_lines",
    "read_mapping",
    "read_query",
    "read_records",
    "read_route",
    "read_table",
    "truncate",
    "write_delimited",
    "write_groups",
    "write_insert",
    "write_jdbc",
    "write_routes",
    "write_snapshot",
]
