"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesnap.llm.common import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest node that each node is connected with.

    ``edges`` has ``u`` and ``v``; the result has ``node`` and ``root``, for nodes that have an edge to another.
    In a round every node first links its larger neighbours to its smallest one, then its smaller ones; the
    number of rounds grows with the logarithm of the longest path. Neighbours are never gathered: their
    minimum is aggregated before the shuffle, and joined back. No edges give no rows.
    """
    u, v = F.col("u"), F.col("v")
    stars = cut(edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    for _ in range(rounds):
        if settled(stars):
            return stars.select(u.alias("node"), v.alias("root"))
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        large = both.join(least, "u").where((v > u) & (v != F.col("m"))).select(v.alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        stars = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    raise RuntimeError(f"The components did not settle in {rounds} rounds.")


def settled(edges: DataFrame) -> bool:
    """Whether distinct edges from larger nodes ``u`` to smaller ones ``v`` are stars: no node has two edges down, and
    none that has one is another's smaller node."""
    ends = [F.struct(F.col(n).alias("node"), F.lit(n == "u").cast("long").alias("down")) for n in ("u", "v")]
    ends = edges.select(F.explode(F.array(*ends)).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("least") == 0)))).first()[0] == 0
