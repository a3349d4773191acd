"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import staged

JUMPS = 3  # times that parents' parents are taken before the links are contracted


def components(links: DataFrame) -> DataFrame:
    """`id, component` of every `id` in `links` (`a`, `b`): the smallest id it reaches.

    Every round hooks each id to its smallest neighbour and replaces ids in the
    links by what they hang on; what is left has at most half the ids. Each round
    is a written table, so no plan grows and lost executors cost one round. Links
    with a null end and links of an id to itself are left out.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = staged(ordered.filter("a < b").distinct(), "component-links")
    assigned: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least"))
        parent = staged(hooked.select("id", F.least("id", "least").alias("parent")), "component-parents")
        for _ in range(JUMPS):
            upper = parent.select(F.col("id").alias("parent"), F.col("parent").alias("grandparent"))
            parent = parent.join(upper, "parent").select("id", F.col("grandparent").alias("parent"))
        parent = staged(parent, "component-parents")
        if assigned is None:
            assigned = parent.select("id", F.col("parent").alias("component"))
        else:
            moved = parent.select(F.col("id").alias("component"), "parent")
            assigned = assigned.join(moved, "component", "left").select(
                "id", F.coalesce("parent", "component").alias("component")
            )
        assigned = staged(assigned, "component-ids")
        left = parent.select(F.col("id").alias("a"), F.col("parent").alias("a2"))
        right = parent.select(F.col("id").alias("b"), F.col("parent").alias("b2"))
        contracted = edges.join(left, "a").join(right, "b").filter("a2 != b2")
        ends = contracted.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = staged(ends.distinct(), "component-links")
    if assigned is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return assigned
