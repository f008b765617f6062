"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written


def _toward_least(edges: DataFrame) -> DataFrame:
    """``u, v, least``: each edge with the least neighbour of ``u``. Joins split hot ends."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("least")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = F.least("u", "least")
    return _toward_least(both).where("v > u").select(F.col("v").alias("u"), least.alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _toward_least(edges)
    moved = near.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = near.select("u", F.col("least").alias("v"))
    return moved.union(own).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node either has one parent and no child, or no parent."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every end of a link ``a, b`` that is not the least of its component; ``root`` is the least.

    Each round is a written table; only whether another is needed comes to the driver.
    """
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while not _all_stars(edges):
        edges = written(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
