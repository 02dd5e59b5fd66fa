"""Dense running numbers over rows that never meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleflow.functions import dates, settlement
from settleflow.operators.dedup import ordering
from settleflow.operators.keyjoin import key_join
from settleflow.session import new_folder

# Groups whose start is sent to every task; more groups than this are joined by shuffle.
BROADCAST_GROUPS = 100_000
# Bits of ``monotonically_increasing_id`` that hold the position inside a partition.
POSITION_BITS = 33


def _numbered(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Add ``_at``, the 0-based position of the row in the order.

    Range partitions sorted inside are written to the shared folder together with the partition and
    position of every row, so that later reads and repeated tasks all see the same ones; a position
    plus the sizes of the partitions before is the number. Sizes need one column of the table. The
    order is total; the task number only splits a long run of rows that are equal in every column.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "sequence")
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    (
        df.withColumn("_task", F.spark_partition_id())
        .repartitionByRange(*order, F.col("_task"))
        .sortWithinPartitions(*order, F.col("_task"))
        .drop("_task")
        .withColumn("_id", F.monotonically_increasing_id())
        .write.parquet(folder)
    )
    placed = spark.read.parquet(folder).withColumn("_part", F.shiftright("_id", POSITION_BITS))
    # One row per partition: the running sum is over as many rows as there are partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    position = F.col("_id").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), F.col("_part") == F.col("_of"))
        .withColumn("_at", F.col("_before") + position)
        .drop("_id", "_part", "_of", "_before")
    )


def with_sequence(
    df: DataFrame,
    col: str,
    order_by: Sequence[Column | str],
    start: int = 1,
    step: int = 1,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows ``start, start + step, ...`` in order, over all rows or per group.

    Rows the order leaves tied are ordered by their other columns, so the numbers do not depend on
    how the rows are partitioned.

    The ordered rows are written below ``spark.checkpoint.dir`` at once; remove that table when the
    result is no longer read.
    """
    if not order_by:
        raise ValueError("order_by is required: a sequence follows an order")
    groups = list(partition_by or [])
    rows = _numbered(df, [*groups, *ordering(df, groups, order_by)])
    at = F.col("_at")
    if groups:
        names = [f"_g{i}" for i in range(len(groups))]
        first = rows.groupBy(*[F.col(g).alias(n) for g, n in zip(groups, names)]).agg(F.min("_at").alias("_first"))
        if first.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
            first = F.broadcast(first)
        rows = key_join(rows, first, groups, names, "inner", null_safe=True)
        at = at - F.col("_first")
    return rows.withColumn(col, F.lit(start).cast("bigint") + at * step).select(*df.columns, col)


def generate_id(
    df: DataFrame,
    source: Column,
    grp: Column,
    order_by: Sequence[Column | str],
    col: str = "entry_id",
    now: Column | None = None,
) -> DataFrame:
    """Give every row an id made of the time, a source, a group and its running number."""
    numbered = with_sequence(df, "_number", order_by)
    made = settlement.entry_id(dates.run_stamp(now), source, grp, F.col("_number"))
    return numbered.withColumn(col, made).drop("_number")
