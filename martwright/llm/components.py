"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.session import cut


def _starred(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """For every node u the edges from its neighbours to the least of them and u.

    The least is an aggregate that is joined back, so a node with many neighbours is never one group.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = pairs.join(least, "u")
    if larger_only:
        return met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    below = met.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the least node of its component) for every node of the edges (u, v).

    Each round points neighbours to the least node near them; it ends when nothing changes, after a
    number of rounds that grows with the logarithm of the longest path.
    """
    plain = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    now = cut(plain.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _starred(both, larger_only=True).filter(F.col("u") != F.col("v")).distinct()
        now = cut(_starred(large, larger_only=False).filter(F.col("u") != F.col("v")).distinct())
