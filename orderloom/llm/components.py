"""Connected components of an edge table by alternating star operations.

Each round hangs neighbours onto the smallest node that is near, first the larger
ones, then the smaller ones, until every component is a star. Rounds are written
to the shared scratch folder; nothing is gathered on the driver but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.scratch import new_scratch, written


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b: bigint).

    Loops, repeated edges and edges in both directions do no harm. Nodes without
    an edge to another node are not in the result.
    """
    spark = edges.sparkSession
    scratch = new_scratch(spark, "components")
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(spark, edges, f"{scratch}/0")
    before = _fingerprint(edges)
    for step in range(1, 100):
        edges = _star(edges, f"{scratch}/{step}-large", larger=True)
        edges = _star(edges, f"{scratch}/{step}-small", larger=False)
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(edges: DataFrame, path: str, larger: bool) -> DataFrame:
    """Edges (a > b) after one star operation, written to ``path``."""
    spark = edges.sparkSession
    if larger:
        # Seen from every node, its larger neighbours move to the smallest of itself and all neighbours.
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        moved = F.col("v") > F.col("u")
    else:
        # Seen from every node, its smaller neighbours and itself move to the smallest of them.
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        moved = F.lit(True)
    smallest = written(spark, seen.groupBy("u").agg(F.min("v").alias("m")), f"{path}-min")
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    # Both inputs are plain shuffles, so a node with very many neighbours is split by Spark.
    result = seen.where(moved).join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger:
        result = result.unionByName(smallest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return written(spark, result.where("a <> b").distinct(), path)
