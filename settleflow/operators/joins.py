"""Lookup joins, and the joins that tell matched from unmatched rows.

No join here forces a broadcast of data: Spark broadcasts a lookup when its size, from file
statistics or measured at run time, is below the session's threshold, and otherwise partitions both
sides by key, where adaptive execution splits what one key has made too big.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.operators.dedup import UNORDERED, uniq_rows
from settleflow.operators.keyjoin import HOT_ROWS, key_join, salted_join, same_keys
from settleflow.operators.rows import Expression, column_of


def lookup_join(
    main: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[Expression, str]],
    how: str = "left",
    name: str | None = None,
    match: str = "all",
    order_by: Sequence[Expression] | None = None,
    salts: int = 0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a lookup flow to the main flow.

    ``on`` pairs an expression over the main flow with a lookup column. ``how`` is ``"left"`` or
    ``"inner"``. With ``name`` every lookup column is called ``name_column`` in the result.
    ``match="first"`` keeps one lookup row per key, the first by ``order_by``, ``match="last"`` the last (by names of
    columns). ``salts`` above 1 spreads keys with at least ``hot_rows`` rows on either side ahead of the shuffle, see
    :func:`salted_join`. A lookup that serves many runs can be kept by key, see :func:`keep_lookup`.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    if not on:
        raise ValueError("a lookup needs join keys")
    if match not in ("all", "first", "last"):
        raise ValueError("match is 'all', 'first' or 'last'")
    if match == "last":
        if not order_by or not all(isinstance(c, str) for c in order_by):
            raise ValueError("the last match needs an order by names of columns")
        keys = [key for _, key in on]
        rest = [f.name for f in lookup.schema.fields if f.name not in {*order_by, *keys} and not isinstance(f.dataType, UNORDERED)]
        lookup = uniq_rows(lookup, keys, [F.col(c).desc_nulls_last() for c in (*order_by, *rest)])
    elif match == "first":
        lookup = uniq_rows(lookup, [key for _, key in on], order_by)
    renamed = {c: f"{name}_{c}" if name else c for c in lookup.columns}
    clash = set(main.columns) & set(renamed.values())
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; give the lookup a name")
    lookup = lookup.withColumnsRenamed(renamed)
    left = [f"_key{i}" for i in range(len(on))]
    right = [renamed[key] for _, key in on]
    keyed = main.withColumns({k: column_of(e) for k, (e, _) in zip(left, on)})
    columns = [*main.columns, *lookup.columns]
    if salts > 1:
        joined = salted_join(keyed, lookup, left, right, how, salts, hot_rows)
    elif match != "all":
        joined = key_join(keyed, lookup, left, right, how)
    else:
        joined = keyed.join(lookup, same_keys(left, right), how)
    return joined.select(*columns)


def keep_lookup(lookup: DataFrame, keys: Sequence[str], name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Keep a lookup as a table in sorted buckets of its keys, so that joins on these keys do not shuffle it again.

    For lookups too big to broadcast that many runs read. A join shuffles only the main flow, to as many partitions as there
    are buckets; Spark prefers that while ``buckets`` is no less than ``spark.sql.shuffle.partitions``. The table is
    replaced if it is there; with ``path`` its files lie there.
    """
    writer = lookup.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return lookup.sparkSession.table(name)


def _key_side(lookup: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Distinct keys of a side that only decides a match, counted map-side before the shuffle."""
    names = [f"_r{i}" for i in range(len(keys))]
    return lookup.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct(), names


def matched(source: DataFrame, target: DataFrame, keys: Sequence[str], target_keys: Sequence[str] | None = None):
    """Source rows whose keys the target has."""
    side, names = _key_side(target, target_keys or keys)
    return key_join(source, side, keys, names, "left_semi")


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str], target_keys: Sequence[str] | None = None):
    """Source rows whose keys the target lacks; a NULL key never matches."""
    side, names = _key_side(target, target_keys or keys)
    return key_join(source, side, keys, names, "left_anti")


def lookup_rejects(main: DataFrame, lookup: DataFrame, on: Sequence[tuple[Expression, str]]) -> DataFrame:
    """Main rows that an inner lookup would drop."""
    left = [f"_key{i}" for i in range(len(on))]
    keyed = main.withColumns({k: column_of(e) for k, (e, _) in zip(left, on)})
    side, names = _key_side(lookup, [key for _, key in on])
    return key_join(keyed, side, left, names, "left_anti").select(*main.columns)
