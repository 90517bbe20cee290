"""Connected components of a link table by alternating large-star and small-star steps.

The least neighbours are staged before they meet the links, so that a node with very many links meets its
own in a join whose skewed partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges here lead from a node to a smaller one."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(u, v)``; the component is its smallest node.

    Nothing but two numbers per step reaches the driver.  The steps end when the edge set repeats,
    which is when every edge leads straight to its component's smallest node.
    """
    edges = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .where("u <> v").distinct(), "components")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = stage(_small_star(_large_star(edges).where("u <> v").distinct()), "components")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
