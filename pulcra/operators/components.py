"""Connected components of links, as joins.

Alternating large and small stars, the published algorithm for map-reduce
components: a round rewires every edge towards the smallest node its ends know,
and the number of rounds is logarithmic in a component's size. Each round is
written to the shared folder, in place of the one before; only its edge count and checksum reach the driver.
The smallest neighbour is a partial aggregate, so a node with very many
neighbours is one row when it is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.session import drop_scratch, scratch_scope, written


def _towards_least(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v): link the neighbours of u to the smallest of them and u;
    large: those above u, small: those below it, and u itself."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    rewired = edges.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        rewired = rewired.unionByName(least.select("u", F.col("m").alias("v")))
    return rewired.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (i, j) to (node, root), root being the smallest node reachable.
    Nodes without a link have no row; null ends and loops are no links."""
    with scratch_scope() as old:
        edges = written(links.select(F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v"))
                        .where("i is not null and j is not null and u <> v").distinct(), "edges")
    seen = None
    while True:
        with scratch_scope() as new:
            edges = written(_towards_least(_towards_least(edges, True), False), "edges")
        drop_scratch(edges.sparkSession, old)  # only the new table is read from now on
        old = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct())
