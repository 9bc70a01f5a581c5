"""Connected components of links between 64-bit numbers, as shuffles of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import cut

MAX_ROUNDS = 60


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b) with a > b.

    Large star: every larger neighbour of a node points to the smallest of its neighbourhood.
    Small star: a node and its smaller neighbours point to the smallest of these.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node but the roots; a root is the smallest node it is linked with.

    ``links`` has columns a and b in either order; loops are ignored. Each round is written to
    the shared folder. Links are stars in the end, and then a round changes nothing.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = cut(ordered.where(F.col("a") > F.col("b")).distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        sign = current.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")
        ).first()
        if sign == seen or not sign[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sign
        current = cut(_round(current))
    raise RuntimeError(f"links are not settled after {MAX_ROUNDS} rounds")
