"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the same for all nodes of a component) of every node of ``edges`` (a, b).

    Each round maps every node to the least of itself and its neighbours and
    replaces edges by those between images, so at least half of the nodes that still
    have edges go. Rounds are written tables; nothing but their emptiness reaches the driver.
    """
    spark = edges.sparkSession
    edges = saved(spark, edges.select("a", "b").where("a != b").distinct(), "edges")
    whole = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("image"))
        step = saved(spark, step, "images")
        if whole is None:
            whole = step.select("node", F.col("image").alias("root"))
        else:
            again = step.select(F.col("node").alias("root"), "image")
            whole = whole.join(again, "root", "left").select("node", F.coalesce("image", "root").alias("root"))
        left, right = (step.select(F.col("node").alias(c), F.col("image").alias(f"i{c}")) for c in "ab")
        edges = edges.join(left, "a").join(right, "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
        edges = saved(spark, edges.where("a != b").distinct(), "edges")
        if edges.isEmpty():
            return saved(spark, whole, "components")
