"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldnorm.llm.storage import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b"), F.col("a"))).toDF("a", "b")


def _to_least(links: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours to the least of them: the larger ones, or the smaller ones and itself."""
    if larger:
        near = _both_ways(links)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("least"))
    moved = near.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", "least"))


def components(links: DataFrame) -> DataFrame:
    """The least node that each node of a table of links (a, b) is connected with: node, least.

    Alternates two steps that link nodes to the least of their neighbours, until every node
    hangs on one that hangs on no other: the number of rounds grows with the logarithm of the
    longest way. A node with very many links is only aggregated or joined, never gathered.
    """
    links = links.select("a", "b").where("a <> b")
    while True:
        links = stored(_to_least(_to_least(links, larger=True), larger=False).where("a <> b").distinct(), "links")
        # Done when no node is linked to two, and none is linked to a node that is itself linked on.
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("from"), F.lit(0).alias("to"))
        ends = ends.union(links.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("from").alias("from"), F.sum("to").alias("to"))
        if ends.where("`from` > 1 or (`from` = 1 and `to` > 0)").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("least"))
