"""Reports over runs, steps and tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settleflow.functions.dates import now as present
from settleflow.plans.groups import GROUPS
from settleflow.sources.tables import GROUP

# How a group without a run is shown.
IDLE, NO_TEXT = "IDLE", "—"


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rows`` of every table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def step_rows(step_log: DataFrame) -> DataFrame:
    """Rows in and out of each step, summed over its models."""
    return step_log.groupBy("run_id", "step").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out")
    )


def run_summary(step_log: DataFrame) -> DataFrame:
    """One row per run from its steps: last status, rows, errors, start, end, duration in seconds.

    ``step_log`` has ``run_id, step, status, rows_in, rows_out, error, timestamp`` and optionally
    ``st_files`` and ``ac_files``, the files a step took in by class. Of steps logged at the same
    time the last by name counts as the later.
    """
    files = [c for c in ("st_files", "ac_files") if c in step_log.columns]
    at = F.col("timestamp")
    return (
        step_log.groupBy("run_id")
        .agg(
            F.max_by("status", F.struct("timestamp", "step", "status")).alias("status"),
            F.count(F.lit(1)).alias("steps"),
            F.sum("rows_in").alias("rows_in"),
            F.sum("rows_out").alias("rows_out"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            *[F.sum(c).alias(c) for c in files],
            F.min(at).alias("start"),
            F.max(at).alias("end"),
        )
        .withColumn(
            "duration_sec",
            F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end")) / F.lit(1_000_000.0),
        )
    )


def group_status(spark: SparkSession, runs: DataFrame, n_groups: int = GROUPS) -> DataFrame:
    """A row per group with its latest run, or the idle defaults.

    ``runs`` has ``grp, status, step, st_files, ac_files, rows, start, duration_sec``.
    """
    fields = ["status", "step", "st_files", "ac_files", "rows", "start", "duration_sec"]
    # The latest run per group by a partial aggregate: a group with most of the runs stays small.
    latest = runs.groupBy(F.col(GROUP).cast("int").alias("_grp")).agg(
        F.max(F.struct("start", *[c for c in fields if c != "start"])).alias("run")
    )
    spine = spark.range(1, n_groups + 1).select(F.col("id").cast("int").alias(GROUP))
    last_run = F.date_format("run.start", "yyyy-MM-dd HH:mm:ss")
    return spine.join(latest, F.col(GROUP) == F.col("_grp"), "left").select(
        GROUP,
        F.coalesce("run.status", F.lit(IDLE)).alias("status"),
        F.coalesce("run.step", F.lit(NO_TEXT)).alias("current_step"),
        F.coalesce("run.st_files", F.lit(0)).cast("bigint").alias("st_files"),
        F.coalesce("run.ac_files", F.lit(0)).cast("bigint").alias("ac_files"),
        F.coalesce("run.rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(last_run, F.lit(NO_TEXT)).alias("last_run"),
        F.coalesce(F.col("run.duration_sec").cast("string"), F.lit(NO_TEXT)).alias("duration"),
    )


def running_count(status: DataFrame) -> DataFrame:
    """How many groups run."""
    return status.agg(F.count_if(F.col("status") == "RUNNING").alias("running"))


def elapsed_since(step_log: DataFrame, step: str, now: Column | None = None) -> DataFrame:
    """Milliseconds from the first entry of a step to now, per run."""
    at = present().cast("timestamp_ntz") if now is None else now
    first = step_log.filter(F.col("step") == step).groupBy("run_id").agg(F.min("timestamp").alias("first"))
    return first.select("run_id", F.timestamp_diff("MILLISECOND", F.col("first"), at).alias("elapsed_ms"))
