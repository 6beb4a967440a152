"""Connected components of a graph given as edges, in rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them.  Edges have ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    """Two equal states are equal edge sets, but for a collision of two 64-bit digests."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all ends of ``edges`` (two columns of long): the smallest node of its component.

    Alternating large-star and small-star rounds; their number grows with the logarithm of the longest
    path.  Every round is written, so a lost executor repeats one round only.  Nodes with many edges are
    aggregated before the shuffle and split by the adaptive skew join.
    """
    u, v = edges.columns
    ends = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    current = written(ends, "edges")
    state = _state(current)
    while state[0]:
        larger = _large_star(current).distinct()
        current = written(_small_star(larger).distinct(), "edges")
        now = _state(current)
        if now == state:
            break
        state = now
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
