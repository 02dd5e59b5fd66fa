"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.tables import written


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: then that node is its component."""
    per_node = edges.groupBy("u").agg(F.count_distinct("v").alias("_n"))
    if not per_node.where("_n > 1").isEmpty():
        return False
    return edges.select(F.col("v").alias("_v")).join(edges, F.col("_v") == F.col("u"), "left_semi").isEmpty()


def _linked_to_least(pairs: DataFrame) -> DataFrame:
    """``u``, ``v``, ``m``: every edge with the least node seen from u.

    The least neighbour is a minimum summed inside map tasks; it is written, so that the join with the
    neighbours has an exchange on both sides and a hub's neighbours can be split over tasks.
    """
    least = pairs.groupBy(F.col("u").alias("_u")).agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return pairs.join(written(least, "graph-least", narrow=True), F.col("u") == F.col("_u")).drop("_u")


def contracted(edges: DataFrame) -> DataFrame:
    """The same components with fewer, lower edges: one large-star and one small-star step.

    Every node links the larger, then the smaller of its neighbours to the least one it knows. ``edges`` has ``v < u``.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = written(
        _linked_to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "graph-large", narrow=True
    )
    # The smaller neighbours and u itself, which stands for each of its edges, join the least.
    small = _linked_to_least(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return written(small.where("u <> v").distinct(), "graph", narrow=True)


def downward(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, without loops and null ends."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``id``, ``component`` of every node of the edges ``u``, ``v``: the least node it can reach.

    Contracts until every edge leads to the least node of its component. The steps only
    regroup edges; nothing but whether it is done reaches the driver. Loops and null ends are ignored.
    """
    edges = written(downward(edges).distinct(), "graph", narrow=True)
    for _ in range(rounds):
        if _settled(edges):
            break
        edges = contracted(edges)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
