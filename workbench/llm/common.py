"""Helpers shared by the operators: tables in the shared folder, row numbers, Arrow texts."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.session import scratch_path

# Fixed value: the white space of the contracts, as a Java regular expression.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends
    here, ids given by position are fixed, and lost executors take nothing with them."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables of ``stored`` that no later step reads, and have the shuffle files of
    finished steps removed: Spark does so once the driver's garbage collector has seen that
    nothing refers to them, and a driver with memory to spare collects too seldom."""
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """All rows and columns with a unique long row number, stored. Rows that repeat a
    doc_id, or have none, keep numbers of their own. Returns the table and the name of
    its new column."""
    row = fresh(df.columns, "row_no")
    return stored(df.withColumn(row, F.monotonically_increasing_id()), name), row


def plain(df: DataFrame, row: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(r, id, text): the columns an operator reads, under names of its own; a null text
    is empty."""
    return df.select(F.col(f"`{row}`").alias("r"), F.col(f"`{id_col}`").alias("id"),
                     text_or_empty(text_col).alias("text"))


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def first_of(id_col: str = "id", row: str = "r") -> Column:
    """Order of the rows of a group: smallest id, null ids last, then the row number."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                    F.col(row).alias("r"))


def ship(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast a value of bounded size, whose classes the executors need not have."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast):
    """What ``ship`` has sent, in a task."""
    return pickle.loads(sent.value)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column without copying it; text k
    is bytes[offsets[k]:offsets[k+1]]. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), offsets


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs [a, b) of texts of at most ``limit`` bytes together (a longer
    text stands alone), so that the arrays over a batch's bytes stay small."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return freed memory to the system, as far as the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Task) -> Task:
    """The mapInArrow function ``run``, with its memory given back when a task ends: workers
    live on for later tasks, and what they hold idly counts against the executor."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


# Bits of the filter that ``rows_with`` sends to every task: 4 MB, whatever the input.
FILTER_BITS = 1 << 25


def _bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS, bool)
    for batch in batches:
        bits[batch.column(0).to_numpy() & (FILTER_BITS - 1)] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _either(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()


def rows_with(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose long ``key`` is in the one column of ``wanted``. A filter of fixed size
    goes to every task first, so that texts nobody wants are not shuffled; the join after
    it is exact."""
    name = wanted.columns[0]
    spark = rows.sparkSession
    parts = wanted.mapInArrow(_bits_of, "bits binary").rdd.map(lambda r: bytes(r.bits))
    none = np.packbits(np.zeros(FILTER_BITS, bool)).tobytes()
    sent = ship(spark, parts.treeReduce(_either, depth=3) if not wanted.isEmpty() else none)
    at = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shipped(sent), np.uint8)).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(bits[batch.column(at).to_numpy() & (FILTER_BITS - 1)]))

    return rows.mapInArrow(run, rows.schema).join(
        wanted.select(F.col(name).alias(key)).distinct(), key, "left_semi")


def filter_of(keys: DataFrame) -> Broadcast:
    """The filter of fixed size over one long column, packed bits by key modulo its length."""
    parts = keys.mapInArrow(_bits_of, "bits binary").rdd.map(lambda r: bytes(r.bits))
    none = np.packbits(np.zeros(FILTER_BITS, bool)).tobytes()
    return ship(keys.sparkSession, none if keys.isEmpty() else parts.treeReduce(_either, depth=3))
