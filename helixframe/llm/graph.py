"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link to another; the component is its smallest node.

    ``edges`` has the columns a and b; links with a null end, and of a node with itself, don't count, and no
    links give no rows. Rounds go on until the links stay as they are, told by their number and 128 bits of
    their hashes. A round writes its links to the shared folder, so no lineage builds up, and what it replaces
    is deleted; the number of rounds grows with the logarithm of the largest component's diameter.
    """
    edges = materialize(edges.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).distinct(), "links")
    before = None
    while True:
        new = materialize(_small_star(_large_star(edges)), "stars")
        discard(edges)
        edges = new
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64(F.lit(1), "b", "a"))).first())
        if now == before or not now[0]:
            break
        before = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
