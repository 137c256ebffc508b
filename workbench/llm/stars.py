"""Verified links inside buckets, without forming all pairs of a bucket.

The least node of a bucket is its head. Every other node is held against the head; the ones
that fail form the bucket's next round, with more heads (1, 4, 16, ...), until none is left.
A round is linear in the rows that are left, and a bucket whose nodes resemble few heads is
done in few rounds; every node ends up linked to a head that it really resembles, or has been
held against all heads of its bucket.

A node that leaves with its head a may still resemble a node c that a does not. One minus
the Jaccard similarity is a metric, so c is then within twice the allowed distance of a: such
near nodes are kept, and those that are not in the class of a by then are held against the
nodes that left with a, as far as the triangle inequality lets them be similar."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workbench.llm.common import stored
from workbench.llm.components import components

GROWTH = 4


def shared(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of keys that have more than one owner (``columns``), by one exchange."""
    bucket, owner = Window.partitionBy("key"), F.struct(*columns)
    return (rows.withColumn("least_owner", F.min(owner).over(bucket))
            .withColumn("last_owner", F.max(owner).over(bucket))
            .filter("least_owner != last_owner").drop("least_owner", "last_owner"))


def rounds() -> Iterator[int]:
    """How many heads each bucket has, round by round."""
    n = 1
    while True:
        yield n
        n *= GROWTH


def ranked(rows: DataFrame, node: Column) -> DataFrame:
    """``rows`` with ``place``: 1, 2, ... by ``node`` within each key."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(node)))


def links(buckets: DataFrame, measured: Callable[[DataFrame], DataFrame], similarity: float,
          name: str) -> DataFrame:
    """Links (a, b) of nodes that resemble each other; any two nodes of a bucket that do are
    in one component of them. ``buckets``: distinct rows (key, node) of keys with more than
    one node; ``measured`` gives (a, b, similarity) of those of its distinct pairs (a, b) that
    are not further apart than twice 1 - ``similarity``."""
    found: list[DataFrame] = []
    held: list[DataFrame] = []
    left = buckets
    for n in rounds():
        left = stored(ranked(left.select("key", "node"), F.col("node")), f"{name}-left")
        heads = left.filter(F.col("place") <= n).select("key", F.col("node").alias("a"))
        pairs = stored(left.join(heads, "key").filter(F.col("a") < F.col("node"))
                       .select("key", "a", F.col("node").alias("b")), f"{name}-pairs")
        if pairs.isEmpty():
            break
        near = stored(measured(pairs.select("a", "b").distinct()), f"{name}-near")
        found.append(near.filter(F.col("similarity") >= similarity).select("a", "b"))
        met = stored(pairs.join(near, ["a", "b"]), f"{name}-met")
        held.append(met)
        linked = (met.filter(F.col("similarity") >= similarity)
                  .select("key", F.col("b").alias("node")).distinct())
        left = left.filter(F.col("place") > n).join(linked, ["key", "node"], "left_anti")
    if not found:
        return buckets.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    first = reduce(DataFrame.unionAll, found).distinct()
    met = reduce(DataFrame.unionAll, held)
    if met.filter(F.col("similarity") < similarity).isEmpty():
        return first
    rest = stored(_between(met, first, similarity), f"{name}-between")
    return first.unionAll(measured(rest).filter(F.col("similarity") >= similarity).select("a", "b")).distinct()


def _between(met: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of nodes that left a bucket with a head, and nodes near that head
    that are not of its class yet, unless the triangle inequality keeps them apart."""
    roots = components(found)
    linked = F.col("similarity") >= similarity
    near = met.filter(~linked)
    for c in "ab":
        near = (near.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
                .withColumn(f"root_{c}", F.coalesce(f"root_{c}", c)))
    near = near.filter("root_a != root_b").select("key", "a", F.col("b").alias("c"),
                                                  F.col("similarity").alias("far"))
    pairs = (met.filter(linked).join(near, ["key", "a"])
             .filter(F.col("far") >= F.col("similarity") + similarity - 1 - 1e-9))
    return pairs.select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct()
