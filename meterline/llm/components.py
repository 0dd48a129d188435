"""Connected components of undirected links, by alternating large and small stars.

Each round links every node to the smallest of its neighbours; the links stay
as many as before or get fewer. A node's smallest neighbour is found by an
aggregate that combines in the map tasks, so a node with very many links costs
no task more than its share. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Large: of each node, the larger neighbours are linked to the smallest of all; small: the smaller ones are."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for the nodes of links ``a``, ``b`` (long)."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        before, state = state, now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        now = stored(_stars(_stars(now, True), False), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
