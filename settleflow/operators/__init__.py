"""Operators over flows (DataFrames)."""

from settleflow.operators.dedup import cap_per_group, dup_rows, net_zero, uniq_rows
from settleflow.operators.joins import keep_lookup, lookup_join, lookup_rejects, matched, unmatched
from settleflow.operators.keyjoin import hot_keys, key_join, salted_join
from settleflow.operators.merge import link_ids, merge_cases, merge_update, merge_upsert, update_status
from settleflow.operators.rows import (
    buffer,
    context_row,
    extract_fields,
    line_rules,
    map_rows,
    merge_flows,
    observe_rows,
    register_routine,
    reject_lines,
    rename,
    route,
    row_program,
    split_lines,
    split_rejects,
    sql_row,
    where,
    with_context,
    with_vars,
)
from settleflow.operators.sequence import generate_id, with_sequence

__all__ = [
    "buffer",
    "cap_per_group",
    "context_row",
    "dup_rows",
    "extract_fields",
    "generate_id",
    "hot_keys",
    "key_join",
    "line_rules",
    "link_ids",
    "keep_lookup",
    "lookup_join",
    "lookup_rejects",
    "map_rows",
    "matched",
    "merge_cases",
    "merge_flows",
    "merge_update",
    "merge_upsert",
    "net_zero",
    "observe_rows",
    "register_routine",
    "reject_lines",
    "rename",
    "route",
    "row_program",
    "salted_join",
    "split_lines",
    "split_rejects",
    "sql_row",
    "uniq_rows",
    "unmatched",
    "update_status",
    "where",
    "with_context",
    "with_sequence",
    "with_vars",
]
