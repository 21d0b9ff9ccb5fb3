"""Connected components of an edge table, by alternating large and small stars.

Every round is two shuffles on a node key and a table in the shared folder, so a lost
executor costs one round. Nothing is collected but one row of counts per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.session import stage


def _stars(edges: DataFrame) -> DataFrame:
    """(node, other, least): each directed edge with the least node around ``node``."""
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return both.join(
        least.select("node", F.least("node", "least").alias("least")), "node"
    )


def _large_star(edges: DataFrame) -> DataFrame:
    stars = _stars(edges).where(F.col("other") > F.col("node"))
    return stars.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where(F.col("low") > F.col("least"))
    return (
        moved.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .union(least.select("high", F.col("least").alias("low")))
        .distinct()
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node it reaches.

    ``edges`` has two non-null columns ``high`` > ``low`` of one ordered type; repeated
    edges are allowed. An empty table gives an empty result.
    """
    now = stage(edges.distinct(), name)
    before = None
    while True:
        now = stage(_small_star(_large_star(now)), name)
        state = now.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")), F.lit(0)),
        ).first()
        if state == before:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
        before = state
