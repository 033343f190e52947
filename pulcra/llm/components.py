"""Connected components as joins: alternating large and small stars.

Each round rewires every edge towards the smallest known neighbour (the
published star algorithm for map-reduce components), which takes a number of
rounds logarithmic in the size of a component. Nodes and edges stay
distributed; a round is written to the shared folder, and only its edge count
and checksum reach the driver. A node with very many neighbours is aggregated
on the map side and then joined as one row, so it makes no large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.llm._base import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` are (u, v). Link the neighbours of u (large: those above u;
    small: those below, and u itself) to the smallest of them and u."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("m", "u").alias("m"))
    wired = edges.join(least, F.col("u") == F.col("c"))
    links = wired.filter("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        links = links.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return links.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, root): root is the smallest node reachable.
    Nodes without a link have no row; null ends and loops are no links."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("a is not null and b is not null and u <> v").distinct(), "edges")
    before = None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
