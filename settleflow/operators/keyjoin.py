"""Equi-joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a hot partition of the left side only when both sides of a sort-merge
join come straight out of a shuffle. A side that was grouped by the same keys would skip that
shuffle and switch the splitting off, so the joins below add a column computed from the keys to
the join condition: it matches whenever the keys do and gives each side a shuffle of its own.
A side small enough to be broadcast is broadcast as ever; Spark checks its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.session import new_folder

LEFT_SLOT, RIGHT_SLOT = "_left_slot", "_right_slot"
# A key is hot when it has more than this share of the rows, so at most 1 / HOT_SHARE keys are, and so many rows.
HOT_SHARE = 0.001
HOT_ROWS = 10_000
# Keys and counters of the frequency sketch: its size does not depend on the data.
SKETCH_KEYS, SKETCH_COUNTERS = 1_000, 10_000


def _hash_types(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]):
    """Types under which equal keys hash alike, or None when the two sides only compare by coercion."""
    types = []
    for a, b in zip(left_keys, right_keys):
        x, y = left.schema[a].dataType, right.schema[b].dataType
        if isinstance(x, T.IntegralType) and isinstance(y, T.IntegralType):
            types.append(T.LongType())
        elif x == y:
            types.append(x)
        else:
            return None
    return types


def key_hash(keys: Sequence[str], types: Sequence[T.DataType]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types)])


def with_slots(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]):
    """Both sides with a column that is equal whenever the keys are; constant columns if types differ."""
    types = _hash_types(left, right, left_keys, right_keys)
    if types is None:
        return left.withColumn(LEFT_SLOT, F.lit(0)), right.withColumn(RIGHT_SLOT, F.lit(0))
    return (
        left.withColumn(LEFT_SLOT, key_hash(left_keys, types)),
        right.withColumn(RIGHT_SLOT, key_hash(right_keys, types)),
    )


def same_keys(left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool = False) -> Column:
    on = F.lit(True)
    for a, b in zip(left_keys, right_keys):
        on = on & (F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b))
    return on


def key_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str,
    null_safe: bool = False,
) -> DataFrame:
    """Join on keys of different names, each right row standing for its key alone."""
    columns = left.columns if how in ("left_semi", "left_anti") else [*left.columns, *right.columns]
    left, right = with_slots(left, right, left_keys, right_keys)
    on = same_keys(left_keys, right_keys, null_safe) & (F.col(LEFT_SLOT) == F.col(RIGHT_SLOT))
    return left.join(right, on, how).select(*columns)


def _key_text(keys: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """A text that tells keys apart; NULL if any of them is."""
    # Adding zero turns -0.0 into 0.0, which is the same key.
    values = [F.col(k).cast(t) + F.lit(0.0) if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) else F.col(k).cast(t) for k, t in zip(keys, types)]
    parts = [value.cast("string") for value in values]
    known = F.lit(True)
    for part in parts:
        known = known & part.isNotNull()
    return F.when(known, F.concat_ws("|", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]))


def hot_keys(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType], least: int = HOT_ROWS) -> DataFrame:
    """Keys as text (``_hot``) with more than ``HOT_SHARE`` of the rows and ``least`` of them, at most 1,000.

    A frequency sketch per task, merged: one pass over the keys and no shuffle of them. It is written, as
    both sides of a join and all its tasks have to see the same keys.
    """
    texts = df.select(_key_text(keys, types).alias("_key")).filter("_key IS NOT NULL")
    top = texts.agg(F.expr(f"approx_top_k(_key, {SKETCH_KEYS}, {SKETCH_COUNTERS})").alias("top"), F.count(F.lit(1)).alias("n"))
    each = top.select(F.explode("top").alias("key"), "n")
    found = each.filter((F.col("key.count") > HOT_SHARE * F.col("n")) & (F.col("key.count") >= least))
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "hot-keys")
    found.select(F.col("key.item").alias("_hot")).write.parquet(folder)
    return spark.read.schema("_hot string").parquet(folder)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str,
    salts: int,
    least: int = HOT_ROWS,
) -> DataFrame:
    """Left or inner join with the hot keys of either side spread over ``salts`` tasks.

    A key is hot with at least ``least`` rows of one side, whatever the size of the other, so the unique keys
    of a lookup never are. Rows of a key hot on the left go to one salt each and its right rows to all; with a
    key hot on the right it is the other way round. All other rows stay single. In a left join, a left row
    that was copied has a match at some salt, as its key is one of the right side's, so its copies
    without a match are left out. The salt is made of the task number: a task that runs again sends its
    rows the same way.

    Each side is read once more to find its hot keys: meant for sides read from files.
    """
    types = _hash_types(left, right, left_keys, right_keys)
    if types is None:
        raise ValueError("a salted join needs keys of the same types on both sides")
    columns = [*left.columns, *right.columns]
    # Both hot sets have a bounded number of rows, whatever the data.
    left_hot = hot_keys(left, left_keys, types, least).withColumn("_left_hot", F.lit(True))
    right_hot = hot_keys(right, right_keys, types, least).withColumn("_right_hot", F.lit(True))
    spread = F.array(F.pmod(F.hash(F.spark_partition_id()), F.lit(salts)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))

    def salted(side: DataFrame, keys: Sequence[str], own: str, other: str, salt: str) -> DataFrame:
        marked = side.withColumn("_key", _key_text(keys, types))
        for hot in (left_hot, right_hot):
            marked = marked.join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left").drop("_hot")
        # A key hot on both sides is spread on the right and copied on the left.
        copied, spreads = F.col(other).isNotNull(), F.col(own).isNotNull()
        if own == "_left_hot":
            where = F.when(copied, every).when(spreads, spread)
        else:
            where = F.when(spreads, spread).when(copied, every)
        return marked.withColumn(salt, F.explode(where.otherwise(F.array(F.lit(0))))).drop("_key", own)

    main = salted(left, left_keys, "_left_hot", "_right_hot", "_salt")
    lookup = salted(right, right_keys, "_right_hot", "_left_hot", "_copy").drop("_left_hot").withColumn("_match", F.lit(True))
    out = main.join(lookup, same_keys([*left_keys, "_salt"], [*right_keys, "_copy"]), how)
    return out.filter(F.col("_right_hot").isNull() | F.col("_match").isNotNull()).select(*columns)
