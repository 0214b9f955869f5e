"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    """Directed (u, v) -> for each u the smallest of u and its neighbours, next to every neighbour.

    The minimum is a partial aggregate joined back, so that a node with very many neighbours is not gathered.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return edges.join(least, "u")


def connected(edges: DataFrame) -> DataFrame:
    """Undirected edges (u, v) of long nodes -> (node, label), label being the smallest node of the component.

    Each step is a written table.  The driver sees two numbers per step: the count and a checksum of the edges.
    """
    u, v, least = F.col("u"), F.col("v"), F.col("least")
    current = written(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "components"
    )
    state = None
    while True:
        both = current.union(current.select(v.alias("u"), u.alias("v")))
        large = _smallest_neighbour(both).where(v > u).select(v.alias("u"), least.alias("v")).distinct()
        # Large-star leaves (u, v) with v < u: small-star links each u's neighbours, and u, to the smallest of them.
        near = _smallest_neighbour(large)
        small = near.where(v != least).select(v.alias("u"), least.alias("v")).union(near.select(u, least.alias("v")))
        current = written(small.distinct(), "components")
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    # Every edge is now (node, smallest node).
    return current.select(u.alias("node"), v.alias("label"))
