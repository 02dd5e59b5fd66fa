"""First row per key, the rows after it, the first rows per class, and entries that cancel out.

A key may hold a large share of all rows, so no operator gathers a key in one task: the first rows
are cut down on the map side, and the rest is found by a difference of bags, which shuffles by
whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.operators.keyjoin import key_join

# Types Spark cannot sort by.
UNORDERED = (T.MapType, T.VariantType)
# Copies of one row that one task writes out.
COPIES_PER_TASK = 100_000


def ordering(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None) -> list[Column]:
    """``order_by`` made total: rows it leaves tied are ordered by their other columns."""
    if not order_by:
        raise ValueError("order_by is required: without an order the first row is arbitrary")
    named = {c for c in order_by if isinstance(c, str)} | set(keys)
    rest = [f.name for f in df.schema.fields if f.name not in named and not isinstance(f.dataType, UNORDERED)]
    return [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col(c) for c in rest]


def _needed(df: DataFrame, keys: Sequence[str], order_by, cols: Sequence[str]) -> DataFrame:
    """Only the columns that decide or are asked for, when the order is given by names."""
    if not order_by or not all(isinstance(c, str) for c in order_by):
        return df
    return df.select(*dict.fromkeys([*keys, *order_by, *cols]))


def ranked(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None, k: int) -> DataFrame:
    """The first ``k`` rows per key with their rank in ``_rank``.

    Spark keeps ``k`` rows per key and map task before the shuffle, so a hot key costs
    ``k`` times the number of map tasks, not its row count.
    """
    window = Window.partitionBy(*keys).orderBy(*ordering(df, keys, order_by))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k)


def uniq_rows(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """The first row per key by ``order_by``; without keys, the distinct rows."""
    cols = list(cols or df.columns)
    if not keys:
        return df.select(*cols).distinct()
    return ranked(_needed(df, keys, order_by, cols), keys, order_by, 1).select(*cols)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Write each row ``times`` times (a column, dropped), sharing a long run among tasks."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c != times]
    n = F.col(times)
    few = df.filter(n <= COPIES_PER_TASK).withColumn("_i", F.explode(F.sequence(F.lit(1), n.cast("int"))))
    many = (
        df.filter(n > COPIES_PER_TASK)
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({times} - 1) div {COPIES_PER_TASK}"))))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        .withColumn("_left", F.least(F.lit(COPIES_PER_TASK).cast("bigint"), n - F.col("_part") * COPIES_PER_TASK))
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_left").cast("int"))))
    )
    return few.select(*columns).union(many.select(*columns))


def dup_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    cols: Sequence[str] | None = None,
    only_once: bool = False,
) -> DataFrame:
    """The rows :func:`uniq_rows` leaves out; with ``only_once`` just the first of them per key."""
    if not keys:
        raise ValueError("duplicates are told by keys")
    cols = list(cols or df.columns)
    df = _needed(df, keys, order_by, cols)
    if only_once:
        return ranked(df, keys, order_by, 2).filter(F.col("_rank") == 2).select(*cols)
    # rows - first rows, as bags: whole rows are the shuffle key, equal rows are counted map-side.
    first = ranked(df, keys, order_by, 1).select(*df.columns)
    signed = df.withColumn("_n", F.lit(1)).union(first.withColumn("_n", F.lit(-1)))
    # Grouping turns -0.0 into 0.0: the sign of a zero is a key of its own and is put back.
    inexact = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    minus = {c: f"_minus{i}" for i, c in enumerate(inexact)}
    signed = signed.withColumns({m: F.when(F.col(c) == 0, F.col(c).cast("string") == "-0.0").otherwise(False) for c, m in minus.items()})
    rest = signed.groupBy(*df.columns, *minus.values()).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    rest = rest.withColumns({c: F.when(F.col(m), F.lit(-0.0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, m in minus.items()})
    return repeat_rows(rest, "_n").select(*cols)


def cap_per_group(
    df: DataFrame, by: Sequence[str], order_by: Sequence[Column | str], k: int, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of every class, with their place in ``rank`` when it is named.

    Rows the order leaves tied are ordered by their other columns, however large ``k`` is.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > threshold:
        # Too many to cut on the map side: number the rows without gathering a class.
        from settleflow.operators.sequence import with_sequence

        out = with_sequence(df, "_rank", ordering(df, by, order_by), partition_by=by).filter(F.col("_rank") <= k)
    else:
        out = ranked(df, by, order_by, k)
    return out.withColumn(rank, F.col("_rank").cast("bigint")).drop("_rank") if rank else out.drop("_rank")


def _exact(df: DataFrame, amount: str, scale: int) -> Column:
    """Amounts as decimals: at the scale of the column, doubles at ``scale`` if they fit it."""
    kind, value = df.schema[amount].dataType, F.col(amount)
    if isinstance(kind, T.DecimalType):
        return value.cast(T.DecimalType(38, kind.scale))
    if isinstance(kind, T.IntegralType):
        return value.cast("decimal(38,0)")
    fits = F.abs(value - F.round(value, scale)) <= 1e-9 * F.greatest(F.abs(value), F.lit(1.0))
    said = F.concat(F.lit(f"{amount} has more than {scale} decimals: "), value.cast("string"))
    return F.when(fits | value.isNull(), value.cast(f"decimal(38,{scale})")).otherwise(
        F.raise_error(said).cast(f"decimal(38,{scale})")
    )


def net_zero(
    df: DataFrame, keys: Sequence[str], amount: str, tol: float = 0, scale: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Separate entries that cancel out: ``(kept, netted)``.

    All rows of a key are netted when there are several and their amounts sum to zero within
    ``tol``. Amounts are summed as decimals, so the order of summation does not matter: at the scale of a decimal
    column, and at ``scale`` for doubles, of which one that has more decimals ends the job. A NULL key matches
    nothing and a NULL amount cancels nothing: such rows are kept.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    known = F.col(amount).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    sums = (
        df.filter(known)
        .groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.sum(_exact(df, amount, scale)).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & (F.abs("_sum") <= F.lit(str(tol)).cast("decimal(38,18)")))
        .select(*names, F.lit(True).alias("_cancels"))
    )
    flagged = key_join(df, sums, keys, names, "left").withColumn("_netted", F.col("_cancels").isNotNull() & known)
    return (
        flagged.filter(~F.col("_netted")).select(*df.columns),
        flagged.filter("_netted").select(*df.columns),
    )
