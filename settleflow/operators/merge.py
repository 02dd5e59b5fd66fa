"""Keyed update and upsert as new snapshots.

A plain file table has no row-level MERGE, so each function returns the rows of the table after
the merge, to be written beside the old ones. Source keys must be unique: give ``order_by`` to
take the first row per key, otherwise a repeated key ends the job. NULL keys never match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleflow.operators.dedup import uniq_rows
from settleflow.operators.joins import unmatched
from settleflow.operators.keyjoin import LEFT_SLOT, RIGHT_SLOT, same_keys, with_slots
from settleflow.operators.rows import Expression, column_of


def _need_keys(keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("a keyed write needs key columns")


def _has_keys(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def _pruned(source: DataFrame, cols: Sequence[str], order_by: Sequence[Column | str] | None) -> DataFrame:
    """Only the columns a merge reads, when its order is given by names: fewer to shuffle and sort."""
    if not all(isinstance(c, str) for c in order_by or ()):
        return source
    return source.select(*dict.fromkeys([*cols, *(order_by or ())]))


def _seen(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Up to two rows per key, numbered in ``_rank``: enough, per map task too, to see that a key repeats."""
    window = Window.partitionBy(*keys).orderBy(*keys)
    return source.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= 2)


def _once(rank: Column) -> Column:
    """True, or the end of the job at the second row of a key."""
    return F.when(rank > 1, F.raise_error(F.lit("merge source has a repeated key"))).otherwise(F.lit(True))


def unique_source(source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None):
    """One row per key, by ``order_by`` or because there is no more than one."""
    if order_by:
        return uniq_rows(source, keys, order_by)
    return _seen(source, keys).filter(_once(F.col("_rank"))).drop("_rank")


def merge_cases(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cases: Sequence[tuple[Expression, Mapping[str, Expression]]],
    order_by: Sequence[Column | str] | None = None,
    cols: Sequence[str] | None = None,
    check: str = "source",
) -> DataFrame:
    """Update the target by the first case that holds, in one join for all cases.

    A case is a condition and ``column -> new value``; both may use target columns as ``t.x`` and
    source columns as ``s.x``. Rows without a match, or without a true case, stay as they are. ``cols`` names the source
    columns the cases read, so that no other is shuffled and sorted. Without an order a repeated source key ends the job;
    with ``check="matched"`` only if the target has the key.
    """
    _need_keys(keys)
    if check not in ("source", "matched"):
        raise ValueError("check is 'source' or 'matched'")
    if cols is not None:
        source = _pruned(source, [*keys, *cols], order_by)
    known = source.filter(_has_keys(keys))
    late = check == "matched" and not order_by
    clean = _seen(known, keys) if late else unique_source(known, keys, order_by)
    left, right = with_slots(target, clean, keys, keys)
    left, right = left.alias("t"), right.alias("s")
    on = same_keys([*[f"t.{k}" for k in keys], LEFT_SLOT], [*[f"s.{k}" for k in keys], RIGHT_SLOT])
    hit = F.col(f"s.{keys[0]}").isNotNull()
    columns = []
    for name in target.columns:
        old = F.col(f"t.{name}")
        value = F
        for condition, changes in cases:
            new = column_of(changes[name]) if name in changes else old
            value = value.when(hit & column_of(condition), new.cast(target.schema[name].dataType))
        columns.append((value.otherwise(old) if any(name in c for _, c in cases) else old).alias(name))
    joined = left.join(right, on, "left")
    if late:
        joined = joined.filter(_once(F.coalesce(F.col("s._rank"), F.lit(1))))
    return joined.select(*columns)


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    check: str = "source",
) -> DataFrame:
    """Set ``set_cols`` (all non-key columns the source has) of matching rows, NULLs included."""
    _need_keys(keys)
    names = set_cols or [c for c in source.columns if c in target.columns and c not in keys]
    source = _pruned(source, [*keys, *names], order_by)
    return merge_cases(target, source, keys, [(F.lit(True), {c: F.col(f"s.{c}") for c in names})], order_by, check=check)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """The source rows, and the target rows no source row replaces."""
    _need_keys(keys)
    if set(target.columns) != set(source.columns):
        raise ValueError("an upsert needs the same columns on both sides")
    keyed = unique_source(source.filter(_has_keys(keys)), keys, order_by)
    no_key = source.filter(~_has_keys(keys))
    kept = unmatched(target, source.filter(_has_keys(keys)), keys)
    return keyed.unionByName(no_key).unionByName(kept).select(*target.columns)


def update_status(
    df: DataFrame, old: str, new: str, condition: Expression | None = None, col: str = "status"
) -> DataFrame:
    """Change one status to another where the condition holds."""
    change = F.col(col) == old
    if condition is not None:
        change = change & column_of(condition)
    return df.withColumn(col, F.when(change, F.lit(new)).otherwise(F.col(col)))


def link_ids(
    templates: DataFrame,
    entries: DataFrame,
    keys: Sequence[str],
    id_col: str = "entry_id",
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Fill the id of each template from the entry with the same keys; others keep theirs."""
    _need_keys(keys)
    ids = _pruned(entries, [*keys, id_col], order_by)
    linked = {id_col: F.coalesce(F.col(f"s.{id_col}"), F.col(f"t.{id_col}"))}
    return merge_cases(templates, ids, keys, [(F.lit(True), linked)], order_by)
