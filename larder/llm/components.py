"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first())


def _hang(edges: DataFrame, at: str, least: DataFrame) -> DataFrame:
    """Attach the least neighbour of column `at`; rows without one keep their own value.

    Both sides come from the shared folder, so that a vertex with very many
    links can be split over tasks at run time.
    """
    return edges.join(least, edges[at] == least["x"], "left").withColumn(
        "m", F.coalesce("m", at)
    ).drop("x")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For each vertex that has a link, the least vertex it can reach: columns node, root.

    Every round contracts large neighbours, then small ones, onto the least
    neighbour, and writes the links that are left. The number of rounds grows
    with the logarithm of the number of vertices; a vertex is never gathered
    with its links, only its least neighbour is computed.
    """
    edges = checkpointed(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("m")).union(
            edges.select(F.col("v"), F.col("u")))
        least = checkpointed(both.groupBy("x").agg(F.min("m").alias("m")).where("m < x"))
        edges = checkpointed(
            _hang(edges, "v", least).where("u != m").select("u", F.col("m").alias("v")).distinct())

        least = checkpointed(edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")))
        lowered = _hang(edges, "u", least).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(lowered.union(least.select("x", "m")).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
