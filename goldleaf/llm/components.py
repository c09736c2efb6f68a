"""Connected components of a link table, by large-star and small-star rounds.

Links stay in Spark: a round is two groupings and two joins, its edges are
written to the shared folder, and the rounds end when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.sources.tables import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (u, v), u > v, hung on the least neighbour of each node.

    The large star moves a node's larger neighbours, the small star the node
    itself and its smaller ones.
    """
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(turned) if larger else edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if larger:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links to one row (node, component) per linked node that is not its component's least.

    The component is the least node that can be reached.  Links may repeat, run
    in either direction or join a node with itself.
    """
    edges = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(),
        "links",
    )
    state = None
    while True:
        seen = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = seen
        edges = materialize(_star(_star(edges, True), False), "links")
