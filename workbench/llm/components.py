"""Connected components by alternating star contractions (distributed union-find).

Each round links the larger neighbours of every node to its smallest neighbour, then the
smaller ones and the node itself; a handful of rounds leaves every node linked to the
smallest node of its component. Rounds are joins and aggregates over the edge table only
and end in a table of the shared folder; nothing is gathered on the driver but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import stored


def _larger_to_least(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (down.join(least, "a").filter(F.col("b") != F.col("m"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b: bigint) that has a
    link to another node; ``root`` is the smallest node of its component. Loops and
    repeated edges do not matter."""
    now = stored(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    mark = None
    while True:
        now = stored(_smaller_to_least(_larger_to_least(now)), "stars")
        row = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if row == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = row
