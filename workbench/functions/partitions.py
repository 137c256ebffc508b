"""Partitioning of frames that iterative fits scan many times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.functions.bounded import only_row
from workbench.session import materialised

# Rows of a part, the most parts of a frame (beyond them parts grow), and the equal rows that
# may lie in one part. Documented parameters of the fits and no functions of the cluster: a
# solver's random start and the order of its sums depend on the parts.
ROWS_PER_PART, MAX_PARTS, EQUAL_ROWS = 75_000, 100_000, 10_000
# Buckets of hashes that rows are counted by first.
HASH_BUCKETS = 65_536


def part_count(rows: int) -> int:
    """Parts for a frame of so many rows: they grow with the rows, whatever runs them."""
    return min(max(1, -(-rows // ROWS_PER_PART)), MAX_PARTS)


def widened(df: DataFrame) -> DataFrame:
    """``df`` for work that is heavy for each row: dealt over all task slots where its files give
    fewer parts than there are slots (a table of one row group is one task otherwise). With
    as many parts as slots or more, which is any large table, nothing is moved."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def spread(df: DataFrame, partitions: int | None = None, *, equal_rows: int = EQUAL_ROWS) -> DataFrame:
    """``df`` in ``part_count`` parts (or ``partitions``) by the hash of its columns, each
    sorted by them: the same rows in the same order on any number of task slots and for any
    layout of the input, so that a seeded fit gives the same model.

    Equal rows have one hash: a value with more than ``equal_rows`` copies is counted, its
    count is cut into pieces of that many, and the pieces are dealt instead, each by its
    own number, and made rows again where they land. One pass over hashes of rows tells
    the number of rows and whether there are such values."""
    cols = df.columns
    hashes = df.groupBy(F.xxhash64(*cols).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = only_row(hashes.agg(F.sum("_n"), F.max("_n")))
    n = partitions or part_count(rows or 0)
    if (most or 0) <= equal_rows:
        return df.repartition(n, *cols).sortWithinPartitions(*cols)
    many = materialised(hashes.where(F.col("_n") > equal_rows).select("_h"), "many-equal")
    hashed = df.withColumn("_h", F.xxhash64(*cols))
    one = F.lit(1).cast("bigint")
    few = hashed.join(many, "_h", "left_anti").select(*cols, F.lit(0).cast("bigint").alias("_piece"),
                                                      one.alias("_size"))
    counted = hashed.join(many, "_h", "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / equal_rows)
    cut = counted.select(*cols, "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_piece"))
    size = F.least(F.lit(equal_rows).cast("bigint"), F.col("_n") - F.col("_piece") * equal_rows)
    dealt = few.unionByName(cut.select(*cols, "_piece", size.alias("_size"))).repartition(n, *cols, "_piece")
    copies = dealt.select(*cols, F.explode(F.array_repeat(F.lit(0), F.col("_size").cast("int"))).alias("_copy"))
    return copies.select(*cols).sortWithinPartitions(*cols)
