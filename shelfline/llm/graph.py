"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.native import Tables


def components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (a, b: long), direction ignored.

    Each round takes the least label among a node and its neighbours, then the label of that label;
    the second step halves the way to go, so long chains take few rounds. Joins meet one row per node,
    so a node with very many edges only makes the side that can be split larger. A round writes one
    table and drops that of the round before.
    """
    tables = tables or Tables(edges.sparkSession, "components")
    own, both = tables.put(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    )
    at, labels = tables.put(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"), F.lit(True).alias("moved"))
    )
    while True:
        labels = labels.drop("moved")
        near = both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("node")).agg(F.min("component").alias("near"))
        closer = labels.join(near, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        up = closer.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = closer.join(up, "component").select("node", F.least("component", "above").alias("component"), "was")
        before = at
        at, labels = tables.put(jumped.select("node", "component", (F.col("component") != F.col("was")).alias("moved")))
        tables.drop(before)
        if not labels.where("moved").take(1):
            tables.drop(own)
            return labels.drop("moved")
