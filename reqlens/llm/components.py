"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqlens.llm.common import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round: a node's larger neighbours (large), or its smaller ones and itself, link to its least neighbour.

    Each direction is grouped with map-side minima and joined back, so a node
    with very many links is never gathered in one task.
    """
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:  # a > b in every link
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        moved = links.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("x")
        ).select("x.a", "x.b")
    return moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of ``links`` (a, b).

    Each round is checkpointed to the shared folder; rounds grow with the
    logarithm of a component's size.  Only two sums per round reach the driver.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = checkpointed(links)
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        links = checkpointed(_star(_star(links, True), False))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
