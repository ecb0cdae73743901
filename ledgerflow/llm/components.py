"""Connected components of a table of links, by alternating star contractions.

Each round first hangs every larger neighbour of a node on the smallest node of
its neighbourhood, then every smaller one: the links shrink towards stars whose
centres are the smallest nodes. Minima are aggregated map-side and joined back,
so a node with very many links is never gathered in one task. Edges are stored
each round; the driver sees their number and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _sum(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) of every node in links (a, b)."""
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(ends, "edges")
    seen = _sum(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
                  .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "components")
