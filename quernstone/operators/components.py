"""Connected components of a table of edges by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.scratch import materialise


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component): the smallest node reachable over edges (u, v), for every node of an edge.

    Each node hangs on the least of itself and its neighbours, and by pointer jumps, which double, on the end of that
    chain; a chain or a star settles in one such round. Each step is written, so a lost executor costs a reread; edges
    inside one component leave, and the rest are drawn between components.
    """
    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    label = materialise(e.select(F.col("u").alias("node")).union(e.select("v")).distinct().withColumn("component", F.col("node")), f"{name}-labels")
    while not e.isEmpty():
        # every component hangs on the least of its neighbours; chains of such links are followed to their ends
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        link = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-links")
        while True:
            far = link.join(link.select(F.col("u").alias("m"), F.col("m").alias("f")), "m")
            link = materialise(far.select("u", F.col("f").alias("m"), (F.col("f") != F.col("m")).alias("moved")), f"{name}-links")
            if link.where("moved").isEmpty():
                break
            link = link.drop("moved")
        link = link.select("u", "m")
        label = materialise(label.join(link.withColumnRenamed("u", "component"), "component", "left").select("node", F.coalesce("m", "component").alias("component")), f"{name}-labels")
        a, b = (link.select(F.col("u").alias(x), F.col("m").alias(f"m{x}")) for x in "uv")
        moved = e.join(a, "u").join(b, "v").where("mu <> mv").select(F.greatest("mu", "mv").alias("u"), F.least("mu", "mv").alias("v")).distinct()
        e = materialise(moved, name)
    return label
