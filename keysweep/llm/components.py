"""Connected components of an edge table, in Spark.

Alternating large-star and small-star steps: every node is rewired to the
smallest node it can see until the edges are stars around the smallest node of
each component. Each step is one aggregation and one join; the edges are
written to the shared checkpoint folder after every round, so the lineage stays
short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    rewired = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rewired.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v: long) that isn't itself the smallest of its component.

    Nodes that don't occur are their own component. Loops are ignored.
    """
    state, mark = staged(edges.where("u <> v").select("u", "v").distinct(), "edges"), None
    while True:
        row = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if row["n"] == 0 or (row["n"], row["h"]) == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (row["n"], row["h"])
        state = staged(_small_star(_large_star(state)), "edges")
