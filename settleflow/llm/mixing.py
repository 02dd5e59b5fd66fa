"""Mixing sources to target weights by Pfair scheduling of blocks."""

from __future__ import annotations

import heapq
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settleflow.llm.tables import filled

#: Most slots of a period: bounds the schedule that is broadcast, whatever the data.
MAX_PERIOD = 10_000
#: Leading hex digits of the order key that cut a source into ranges.
DIGITS = 3


def period(shares: dict[str, int]) -> list[str]:
    """The source of every slot of one period, as many slots as the shares sum to.

    Block ``k`` (from 0) of a source with share ``n`` of ``q`` slots may not start before slot
    ``floor(k q / n)`` and has to be done by ``ceil((k + 1) q / n)``. Of the released blocks the one with
    the earliest deadline runs, ties by name. The weights sum to one, so every deadline is met and after any number of slots a
    source is less than one block away from its weight. The schedule repeats after ``q`` slots.
    """
    if any(n < 0 or n != int(n) for n in shares.values()):
        raise ValueError("shares are whole numbers of slots")
    shares = {name: int(n) for name, n in shares.items() if n}
    common = gcd(*shares.values()) if shares else 1
    shares = {name: n // common for name, n in shares.items()}
    slots = sum(shares.values())
    if slots > MAX_PERIOD:
        raise ValueError(f"shares sum to {slots} slots, {MAX_PERIOD} are allowed")
    waiting = [(0, name, 0) for name in shares]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    order = []
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, name, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * slots // shares[name]), name, k))
        deadline, name, k = heapq.heappop(ready)
        assert slot < deadline
        order.append(name)
        heapq.heappush(waiting, ((k + 1) * slots // shares[name], name, k + 1))
    return order


def in_source(docs: DataFrame, source: Column, id: str, carried: list[str]) -> DataFrame:
    """Rows with ``_source`` and ``_at``, the 0-based place in their source in the order of the md5 of the id.

    Every source is cut into ranges of the md5; a window numbers each range and the sizes of the ranges
    before are added, so no task holds a source.
    """
    key = F.md5(filled(F.col(id)))
    rows = docs.select(
        *carried, source.alias("_source"), key.alias("_key"), F.substring(key, 1, DIGITS).alias("_range")
    )
    sizes = rows.groupBy("_source", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_source").alias("_of"), F.col("_range").alias("_in"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    order = Window.partitionBy("_source", "_range").orderBy("_key", id)
    placed = rows.withColumn("_within", F.row_number().over(order) - 1)
    same = F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in"))
    return placed.join(starts, same).withColumn("_at", F.col("_start") + F.col("_within"))


def mix(
    docs: DataFrame, shares: dict[str, int], block: int = 64, id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """Every row's place in a mixture: ``doc_id``, ``source``, ``block``, ``slot``, ``position``, ``on_target``.

    ``shares`` gives the slots of each source in a period of ``sum(shares)`` slots; a slot is a block of
    ``block`` rows of one source. Inside a source, rows go by the md5 of their id, a fixed shuffle. The
    schedule of one period (:func:`period`, at most ``MAX_PERIOD`` slots) gives the slot of every block by arithmetic, so
    the work is one numbering and two broadcasts of bounded tables, whatever the data.

    ``position`` orders the mixture. No row is dropped or repeated: when a source runs out its slots stay
    empty and the others go on in proportion. ``on_target`` is true up to the first slot whose block is missing
    or not full; there every source is within one block of its weight.

    Rows of sources without a share, null sources included, have a null ``slot`` and ``position`` and are not on target.
    Null ids come as if empty; repeated ids are in arbitrary order beside each other. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    order = period(shares)
    if not order:
        raise ValueError("no source has a share")
    seen: dict[str, int] = {}
    table = []
    for slot, name in enumerate(order):
        table.append((name, seen.setdefault(name, 0), slot))
        seen[name] += 1
    schedule = spark.createDataFrame(table, "_name string, _turn long, _slot long")
    each = spark.createDataFrame(list(seen.items()), "_owner string, _share long")
    slots = len(order)
    at = in_source(docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source")), F.col("source"), "doc_id", ["doc_id", "source"])
    at = at.join(F.broadcast(each), F.col("_source") == F.col("_owner"), "left").withColumn("block", F.floor(F.col("_at") / block))
    placed = at.join(
        F.broadcast(schedule),
        (F.col("_source") == F.col("_name")) & (F.pmod("block", "_share") == F.col("_turn")),
        "left",
    ).withColumn("slot", F.floor(F.col("block") / F.col("_share")) * slots + F.col("_slot"))
    # The first block that is missing or not full, of every source with a share: one row each.
    full = (
        docs.groupBy(F.col(source).alias("_name"))
        .agg(F.floor(F.count(F.lit(1)) / block).alias("_full"))
        .join(F.broadcast(each), F.col("_name") == F.col("_owner"), "right")
        .select("_owner", "_share", F.coalesce("_full", F.lit(0)).alias("_full"))
    )
    turn = schedule.withColumnsRenamed({"_name": "_who"})
    horizon = full.join(
        F.broadcast(turn), (F.col("_owner") == F.col("_who")) & (F.pmod("_full", "_share") == F.col("_turn"))
    ).agg(F.min(F.floor(F.col("_full") / F.col("_share")) * slots + F.col("_slot")).alias("_until"))
    until = F.lit(horizon.first()["_until"])
    return placed.select(
        "doc_id",
        "source",
        "block",
        "slot",
        (F.col("slot") * block + F.pmod("_at", F.lit(block))).alias("position"),
        F.coalesce(F.col("slot") < until, F.lit(False)).alias("on_target"),
    )
