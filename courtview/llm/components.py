"""Connected components of a link table, in Spark, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtview.llm.common import discard, write_scratch

MAX_ROUNDS = 200


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b); unlinked nodes do not appear.

    Alternates large-star and small-star steps: each node links its larger (then its smaller) neighbours to the
    smallest one, until the links form stars. Every step is written to the shared folder, which cuts the lineage.
    A hub is a key with many neighbours: its minimum is a partial aggregate, and the join back to the link rows
    reads a written table on both sides, so that adaptive execution can split it.
    """
    spark = links.sparkSession
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path = write_scratch(edges, f"{name}-links")
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges2, path2 = write_scratch(_star(both, larger=True), f"{name}-large")
        edges3, path3 = write_scratch(_star(edges2, larger=False), f"{name}-small")
        discard(spark, path, path2)
        edges, path = edges3, path3
    else:
        raise RuntimeError("connected components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large-star keeps, for each node, its larger neighbours; small-star its smaller ones; all point at the least."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    joined = edges.join(least, "a")
    if larger:
        new = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return new.filter(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one only, which has none itself: the stars of the components."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0] == 0
