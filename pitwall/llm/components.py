"""Connected components of an edge table, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.session import materialise


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number and order-free digest of the edges: equal marks end the rounds."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point at the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (columns u, v; u != v), where
    root is the smallest node that can be reached.

    Alternates large-star and small-star rounds until nothing changes; both are
    a partial aggregate and a join, so a node with very many links is combined
    before the shuffle and split by adaptive execution in the join.  Each round
    is written to the shared folder.
    """
    current = materialise(edges.filter("u is not null and v is not null and u != v").select("u", "v").distinct())
    mark = _mark(current)
    while mark[0]:
        current = materialise(_small_star(_large_star(current)))
        now = _mark(current)
        if now == mark:
            break
        mark = now
    least = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return least.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
