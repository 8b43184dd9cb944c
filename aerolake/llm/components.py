"""Connected components of a link table, by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest neighbour
(large star), then all its smaller neighbours (small star), until the links form
one star per component.  Every step is a map-side combined minimum and a join
that adaptive execution can split, so hubs are no bottleneck; each round's links
are written to shared storage.  Nothing but a count and a checksum reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the least node
    of its component.  Links of a node with itself and nulls are ignored."""
    edges = stored(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(smallest.select("u", F.col("m").alias("v"))).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())
