"""Composite jobs: group routing, the settlement load and run reports."""

from settleflow.plans.groups import route_files, run_groups
from settleflow.plans.pipeline import (
    EntrySpec,
    SyncSpec,
    apply_pay_dates,
    apply_type4,
    close_activity,
    final_load,
    post_job,
    post_sync,
    stage_activity,
    stage_entries,
)
from settleflow.plans.runlog import (
    elapsed_since,
    group_status,
    row_counts,
    run_summary,
    running_count,
    step_rows,
)

__all__ = [
    "EntrySpec",
    "SyncSpec",
    "apply_pay_dates",
    "apply_type4",
    "close_activity",
    "elapsed_since",
    "final_load",
    "group_status",
    "post_job",
    "post_sync",
    "route_files",
    "row_counts",
    "run_groups",
    "run_summary",
    "running_count",
    "stage_activity",
    "stage_entries",
    "step_rows",
]
