"""Place of every node in chains of pointers, by pointer doubling.

Each node names at most one node before it. In a round every node that isn't done looks at the node it points to and takes
over where that one points, so the way known doubles: the number of rounds grows with the logarithm of the longest chain.
Nodes done leave the join, which keeps the first node of a long chain from being everyone's key. What has no first node
is a ring, or hangs on one. Rounds go through written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.session import stage


def places(nodes: DataFrame) -> DataFrame:
    """``node, first, place, kind`` of rows ``node, before``; ``node`` is unique, of any type that can be ordered.

    ``chain``: ``first`` is the node the chain begins with, and ``place`` counts from it. ``ring``: the node comes back to
    itself, ``first`` is the least node of its ring. ``behind``: it leads back to a ring, ``first`` is that ring's least.
    Places of the latter two are null. ``before`` must be a node or null; an empty table gives no rows.
    """
    start = F.col("before").isNull()
    state = stage(
        nodes.select("node", F.coalesce("before", "node").alias("at"), F.when(start, 0).otherwise(1).cast("bigint").alias("steps"), start.alias("done"), F.col("node").alias("least")),
        "places",
    )
    left, way = state.where("NOT done").count(), 1
    while left:
        to = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("steps").alias("more"), F.col("done").alias("ends"), F.col("least").alias("lesser"))
        further = state.where("NOT done").join(to, "at").select(
            "node", F.col("further").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ends").alias("done"), F.least("least", "lesser").alias("least")
        )
        state = stage(state.where("done").unionByName(further), "places")
        before, left, way = left, state.where("NOT done").count(), 2 * way
        if left == before and way > left:  # nobody gets done any more, and everyone has gone round
            break
    chains = state.where("done").select("node", F.col("at").alias("first"), F.col("steps").alias("place"), F.lit("chain").alias("kind"))
    if not left:
        return chains
    # As many steps back as there are such nodes end on a ring, and those of a ring end on every node of it.
    rounds = state.where("NOT done")
    on_ring = stage(rounds.select(F.col("at").alias("on")).distinct(), "rings")
    rings = stage(rounds.join(on_ring, rounds["node"] == on_ring["on"]).select(F.col("node").alias("on"), F.col("least").alias("name")), "rings")
    at_ring = rounds.join(rings.withColumnRenamed("on", "at"), "at").select("node", F.col("name").alias("first"))
    named = at_ring.join(on_ring, at_ring["node"] == on_ring["on"], "left")
    kind = F.when(F.col("on").isNotNull(), "ring").otherwise("behind")
    return chains.unionByName(named.select("node", "first", F.lit(None).cast("bigint").alias("place"), kind.alias("kind")))
