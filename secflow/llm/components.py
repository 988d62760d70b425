"""Connected components of a table of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import checkpoint


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node on the least of the node and its neighbours."""
    ways = _both_ways(links)
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (BIGINT columns a, b) the least node that it reaches.

    Alternating star contraction; the number of rounds grows with the logarithm of the longest path. Each round is
    checkpointed, so a lost executor costs one round. Links with a null end or both ends equal are left out.
    """
    links = checkpoint(
        links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct()
    )
    mark = None
    while True:
        links = checkpoint(_small_star(_large_star(links)))
        now = tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(pmod(xxhash64(b, a), 1048573))")).first())
        if now == mark or not now[0]:
            break
        mark = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
