"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, folders


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the smallest node of its component.

    Each round every node's larger neighbours are linked to the smallest node of its neighbourhood,
    then its smaller ones; edges never grow in number and the count of rounds is logarithmic in the
    components' size.  Minima are aggregated before they are joined back, so a node with very many
    neighbours costs no task more than its share; each round ends in a written table.
    """
    spark = edges.sparkSession
    edges = cut(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, since = None, len(folders()) - 1
    for _ in range(rounds):
        sides = both_ways(edges)
        # written first: a join with a written table can be split where one node is hot
        least = cut(sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = sides.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = cut(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        discard(spark, since)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
