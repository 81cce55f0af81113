"""Connected components of a link table as Spark jobs: hook to a smaller neighbour, jump to the root, contract, repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node reachable.

    Each round at least halves the nodes that still have links; every round's tables are written to the shared folder.
    """
    spark = links.sparkSession
    edges = common.staged(links.select("a", "b").where("a <> b").distinct(), "cc-edges")
    roots = common.staged(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                          .select("node", F.col("node").alias("root")), "cc-roots")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = common.staged(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up")), "cc-up")
        while True:
            over = up.select(F.col("node").alias("up"), F.col("up").alias("over"))
            jumped = common.staged(up.join(over, "up").select("node", F.col("over").alias("up"), (F.col("over") != F.col("up")).alias("moved")), "cc-up")
            common.remove(spark, up)
            up = jumped
            if jumped.where("moved").isEmpty():
                break
        before = roots, edges
        roots = common.staged(roots.join(up.select(F.col("node").alias("root"), "up"), "root", "left")
                              .select("node", F.coalesce("up", "root").alias("root")), "cc-roots")
        ends = {c: up.select(F.col("node").alias(c), F.col("up").alias(f"{c}2")) for c in "ab"}
        edges = common.staged(edges.join(ends["a"], "a").join(ends["b"], "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
                              .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
        common.remove(spark, up, *before)
    common.remove(spark, edges)
    return roots
