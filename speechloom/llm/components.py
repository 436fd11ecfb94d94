"""Connected components of an edge table, by alternating star operations (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import checkpoint


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root is the smallest node of its component.

    Each round hangs the larger neighbours of every node on its smallest one, then the smaller ones; both are a minimum
    by key and a join. The end is reached when each node hangs on one, and that on none. The number of rounds grows with the
    logarithm of the size of a component; nothing is collected.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = checkpoint(both)
    for _ in range(rounds):
        # large star: each node's larger neighbours hang on the smallest of its neighbours and itself
        around = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: each node and its smaller neighbours hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        now = checkpoint(small)
        hung = now.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        if hung.filter("n > 1").isEmpty() and now.select(F.col("v").alias("u")).join(hung, "u", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
