"""Connected components of an edge table, by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the node's smallest neighbour,
small-star links the node and its smaller neighbours to the smallest; components keep
their nodes, and after a few rounds every node hangs on its component's smallest. Only
per-node minima are computed (pre-aggregated before the shuffle) and joined back, so a
node with very many neighbours is one key with one minimum. Every round is written to
the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import stage


def _with_minimum(arcs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours v."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")) \
        .select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return arcs.join(least, arcs["u"] == least["_u"]).drop("_u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct())


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_minimum(down)
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .union(linked.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has long columns u, v. Returns (node, root) for every node with an edge to
    another node; root is the smallest node of the component (the root itself included).
    Self links are ignored; no edges give no rows."""
    now = stage(edges.select("u", "v").where("u != v"), "edges")
    seen = None
    while True:
        now = stage(small_star(large_star(now)), "stars")
        sums = now.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (sums["n"], sums["h"]) == seen or not sums["n"]:
            break
        seen = (sums["n"], sums["h"])
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
