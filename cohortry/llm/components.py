"""Connected components of a link table by alternating star contractions, each a join and an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import staged


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """For each node of ``links`` its component, named by the least node: node, component.

    Nodes are of any orderable type. Every round points each node of a star at the least node seen there; rounds are
    staged and end when a round changes nothing. Null ends and self links are ignored; an empty table gives an empty one.
    """
    edges = links.where(F.col(left) != F.col(right)).select(F.greatest(left, right).alias("node"), F.least(left, right).alias("to")).distinct()
    edges, seen = staged(edges, "edges"), None
    while True:
        both = edges.select(F.explode(F.array(F.struct("node", "to"), F.struct(F.col("to").alias("node"), F.col("node").alias("to")))).alias("e")).select("e.*")
        least = both.groupBy("node").agg(F.min("to").alias("best"))
        # larger neighbours of a node move to the least neighbour, or the node itself if that is less
        near = both.join(least, "node").select("node", "to", F.least("node", "best").alias("best"))
        large = near.where(F.col("to") > F.col("node")).select(F.col("to").alias("node"), F.col("best").alias("to")).distinct()
        # then smaller neighbours, and the node, move to the least of them
        low = large.groupBy("node").agg(F.min("to").alias("best"))
        near_least = large.join(low, "node").select(F.explode(F.array(F.struct("node", F.col("best").alias("to")), F.struct(F.col("to").alias("node"), F.col("best").alias("to")))).alias("e"))
        edges = staged(near_least.select("e.*").where(F.col("node") != F.col("to")).distinct(), "edges")
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()
        if found == seen:
            return edges.groupBy("node").agg(F.min("to").alias("component")).union(edges.select("to", "to").distinct())
        seen = found
