"""Skew-safe running totals and dense numbering.

A per-key running sum written as ``Window.partitionBy(key).orderBy(o)`` sends every row
of a key to one task; with one key holding a third of the data that task is the job.
Here the rows are range-partitioned on (key, order) instead, so a hot key is cut into
many contiguous chunks, and the total of each earlier chunk is added back:

1. ``repartitionByRange(n, key, order)`` and record the chunk (partition) id; the
   result is checkpointed to the shared folder so both uses below read the same chunks;
2. per (key, chunk) totals — at most #keys + #chunks rows;
3. offset of a chunk = sum of the key's earlier chunk totals (a window over at most
   #chunks rows per key);
4. running sum inside each (key, chunk), plus the offset.

The (key, order) pairs must be unique (aggregate ties first), so "rows before" is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows of a chunk, when the caller names no number of chunks.
CHUNK_ROWS = 250_000


def _chunks(df: DataFrame, cols: Sequence[str], partitions: int | None) -> DataFrame:
    # chunks grow in number with the data, not in size
    n = partitions or max(1, -(-df.count() // CHUNK_ROWS))
    ranged = df.repartitionByRange(n, *cols).withColumn("_chunk", F.spark_partition_id())
    # reliable checkpoint: survives executor loss and pins the chunk ids
    return ranged.checkpoint(eager=True)


def running_total(df: DataFrame, key: str | None, order: Sequence[str], value: str,
                  out: str, *, inclusive: bool = True,
                  partitions: int | None = None, chunk: Column | None = None) -> DataFrame:
    """Add ``out`` = Σ ``value`` over rows of the same ``key`` ordered at or before
    (``inclusive``) or strictly before this row by ``order``. ``key=None``: one global
    running total.

    ``chunk``: an integer expression that already cuts each key into ordered pieces
    (non-decreasing along ``order``, e.g. fixed-width blocks of an integer order
    column). Being a function of the row, it needs neither the range sampling pass nor
    the checkpoint."""
    keys = [key] if key else []
    if chunk is not None:
        ranged = df.withColumn("_chunk", chunk)
    else:
        ranged = _chunks(df, keys + list(order), partitions)
    totals = ranged.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_t"))
    w_prev = (Window.partitionBy(*keys).orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, "_chunk",
                            F.coalesce(F.sum("_t").over(w_prev), F.lit(0)).alias("_off"))
    if not keys:
        # one row per chunk: bounded by the partition count
        offsets = F.broadcast(offsets)
    w_in = (Window.partitionBy(*keys, "_chunk").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = F.sum(value).over(w_in) + F.col("_off")
    if not inclusive:
        run = run - F.col(value)
    return (ranged.join(offsets, keys + ["_chunk"])
            .withColumn(out, run).drop("_chunk", "_off"))


def dense_index(df: DataFrame, col: str, out: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """Number the distinct values of ``col`` 0..n-1 in ascending order, without sending
    them through one task (a global ``row_number`` would)."""
    d = df.select(col).distinct().withColumn("_one", F.lit(1))
    return (running_total(d, None, [col], "_one", out, inclusive=False,
                          partitions=partitions)
            .select(col, F.col(out).cast("bigint").alias(out)))
