"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b): the smallest node that each node reaches.

    Each round every node joins the neighbour (or itself) that comes first in a random order, and
    the graph shrinks to the nodes so chosen; a chain halves, a star is gone in two rounds. All
    state lies in written tables. Nodes without an edge to another are not returned.
    """
    left = stored(edges.where("a <> b").select("a", "b").distinct())
    leaders = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        rank = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("node"))
        near = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("node"))
        chosen = both.groupBy("a").agg(F.min(near).alias("near")).select(
            F.col("a").alias("node"), F.least("near", rank)["node"].alias("leader")
        )
        leaders.append(stored(chosen))
        step = leaders[-1]
        left = stored(
            left.join(step.toDF("a", "la"), "a")
            .join(step.toDF("b", "lb"), "b")
            .where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct()
        )
    if not leaders:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = leaders[0]
    for step in leaders[1:]:
        found = found.join(step.toDF("leader", "next"), "leader", "left").select(
            "node", F.coalesce("next", "leader").alias("leader")
        )
    found = stored(found)
    least = found.groupBy("leader").agg(F.min("node").alias("component"))
    return found.join(least, "leader").select("node", "component")
