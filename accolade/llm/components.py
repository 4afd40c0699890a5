"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accolade.sources.sinks import cut


def _star(edges: DataFrame, pulled: bool) -> DataFrame:
    """Links of each node's neighbours to the smallest of them.

    ``pulled`` takes the neighbours below the node (and the node); otherwise those above it.
    """
    both = edges if pulled else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("at")).agg(F.least(F.min("v"), F.first("u")).alias("least"))
    near = both.join(least, F.col("u") == F.col("at"))
    if pulled:  # edges run downwards: (u, v) with v < u
        moved = near.select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("at", "least"))
    else:
        moved = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): each linked node that is not the smallest of its component, and the smallest.

    ``links`` has columns u and v of one type.  Rounds of large and small stars, each written to
    the shared folder; their number grows with the logarithm of a component's diameter.  A
    node's neighbours are joined, not gathered, so a node with any number of links is fine.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    while True:
        edges = cut(_star(_star(edges, pulled=False), pulled=True), "stars")
        n, nodes = edges.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        # one link for each node, and none to a node that is linked itself: every component is a star
        if n == nodes and edges.join(edges.select(F.col("v").alias("of")), F.col("u") == F.col("of"), "left_semi").isEmpty():
            return edges
