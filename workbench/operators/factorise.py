"""Truncated singular value decomposition of a long sparse matrix, by randomised range finding.

The matrix is (row key, column number, value). Only products of the matrix with a thin one are
distributed: a pass sends V (columns x width) to all tasks, each multiplies its rows by it and
their transpose by the result, and the sums come back. Rows, their left vectors and the matrix
itself stay where they are. What passes through the driver has as many rows as the matrix has
columns: a bounded vocabulary, at most ``MAX_COLUMNS``.

The range is found by block Krylov steps from a random start that is a function of the seed
and the column number, with full orthogonalisation and restarts at the best vectors, until
the residuals of the wanted vectors are small. Nothing depends on the layout of the rows but
the order of additions.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.session import materialised

MAX_COLUMNS = 200_000
# Vectors beyond the wanted ones, steps between restarts, passes at most, entries of the rows
# taken at a time in a task, and entries multiplied at a time: products of so many stay in a
# core's cache, larger ones are written to memory and read again.
SPARE, STEPS, MAX_PASSES, SLICE, AT_ONCE = 10, 4, 200, 1 << 16, 1 << 12


class Svd(NamedTuple):
    """``values``: (component, sigma, residual), components 1, 2, ... by falling sigma;
    ``left``: (key, u array<double>) for every row with an entry; ``right``: (column, v
    array<double>). residual: the length of A'Av - sigma^2 v over sigma^2."""

    values: DataFrame
    left: DataFrame
    right: DataFrame


def _entries(batch: pa.RecordBatch, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns, values and first entries of the rows first, ..., end - 1 of a batch."""
    at, value = batch.column(1).slice(first, end - first), batch.column(2).slice(first, end - first)
    ends = at.offsets.to_numpy()
    return at.flatten().to_numpy(), value.flatten().to_numpy(), ends - ends[0]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Runs of rows with about SLICE entries together."""
    ends = batch.column(1).offsets.to_numpy()
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(ends, ends[a] + SLICE, side="right")) - 1
        b = min(max(b, a + 1), batch.num_rows)
        yield a, b
        a = b


def _times(at: np.ndarray, value: np.ndarray, ends: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The product of sparse rows, none of them empty, with a thin matrix."""
    out = np.empty((len(ends) - 1, v.shape[1]))
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + AT_ONCE, side="right")) - 1)
        first, end = ends[a], ends[b]
        part = v[at[first:end]]
        part *= value[first:end, None]
        np.add.reduceat(part, ends[a:b] - first, axis=0, out=out[a:b])
        a = b
    return out


def _transposed(at: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the entries by column, the columns' first places in it and one more at the end,
    and the row of each entry in that order. Columns of 16 bits are sorted by radix."""
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
    col = at[order]
    begin = np.concatenate(([0], np.flatnonzero(col[1:] != col[:-1]) + 1, [len(col)]))
    return order, begin, np.repeat(np.arange(len(ends) - 1), np.diff(ends))[order]


def _gram(sent, shape: tuple[int, int]):
    """mapInArrow function: the rows' share of A'(A V), one row for a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.frombuffer(sent.value).reshape(shape)
        out = np.zeros(shape)
        for batch in batches:
            for a, b in _slices(batch):
                at, value, ends = _entries(batch, a, b)
                y = _times(at, value, ends, v)
                order, begin, owner = _transposed(at, ends, shape[0])
                out[at[order[begin[:-1]]]] += _times(owner, value[order], begin, y)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])
    return run


def _left(sent, shape: tuple[int, int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = np.frombuffer(sent.value).reshape(shape)
        for batch in batches:
            parts = [_times(*_entries(batch, a, b), v) for a, b in _slices(batch)]
            u = np.concatenate(parts) if parts else np.zeros((0, shape[1]))
            flat = pa.array(u.reshape(-1))
            ends = pa.array(np.arange(0, u.size + 1, shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat)], names)
    return run


def _add(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def _gram_times(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """A'(A V): one distributed pass; partial sums meet pairwise on the executors."""
    sent = rows.sparkSession.sparkContext.broadcast(v.tobytes())
    parts = rows.mapInArrow(_gram(sent, v.shape), "part binary").rdd.map(lambda r: bytes(r.part))
    out = np.frombuffer(parts.treeReduce(_add, depth=3)).reshape(v.shape)
    sent.unpersist()
    return out


def _basis(w: np.ndarray, held: np.ndarray, scale: float) -> np.ndarray:
    """An orthonormal basis of the part of w that is orthogonal to ``held``, without
    directions that are nothing but rounding next to ``scale``."""
    for _ in range(2):
        w = w - held @ (held.T @ w)
    q, s, _ = np.linalg.svd(w, full_matrices=False)
    return q[:, s > scale * 1e-13]


def start_vectors(n: int, width: int, seed: int) -> np.ndarray:
    """Standard normal numbers, each a function of seed, row and column."""
    return np.random.Generator(np.random.Philox(key=seed)).standard_normal((n, width))


def top_eigenvectors(times, n: int, k: int, *, spare: int = SPARE, steps: int = STEPS, tol: float = 1e-9,
                     max_passes: int = MAX_PASSES, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (fewer, if the rest is zero), their vectors and residuals
    of a symmetric positive matrix of n rows that is only known by ``times(V)``."""
    width = min(n, k + spare)
    block = np.linalg.qr(start_vectors(n, width, seed))[0]
    passes, scale = 0, 0.0
    while True:
        basis, image = [block], [times(block)]
        scale = max(scale, float(np.linalg.norm(image[0], 2)))
        passes += 1
        if scale == 0:
            return np.zeros(0), np.zeros((n, 0)), np.zeros(0)
        for _ in range(steps - 1):
            more = _basis(image[-1], np.hstack(basis), scale)
            if not more.shape[1]:
                break
            basis.append(more)
            image.append(times(more))
            passes += 1
        q, mq = np.hstack(basis), np.hstack(image)
        inner = q.T @ mq
        theta, s = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-theta)[:width]
        theta, s = theta[order], s[:, order]
        block = q @ s
        size = min(k, int((theta > theta[0] * 1e-12).sum()))
        residual = np.linalg.norm(mq @ s[:, :size] - block[:, :size] * theta[:size], axis=0) / theta[:size]
        if residual.max(initial=0) <= tol or passes >= max_passes:
            return theta[:size], block[:, :size], residual
        block = np.linalg.qr(block)[0]


def truncated_svd(matrix: DataFrame, key: str, col: str, value: str, n_cols: int, k: int, *,
                  tol: float = 1e-9, seed: int = 42, **options) -> Svd:
    """The ``k`` largest singular values and their vectors of the matrix with rows ``key``,
    columns numbered 0, ..., ``n_cols`` - 1 in ``col`` and entries ``value`` (absent: 0;
    repeated entries are added). Of each right vector the entry of greatest size is positive
    (the first of equals), which fixes all signs. A matrix of lower rank has fewer values; an
    empty one has none."""
    if n_cols > MAX_COLUMNS:
        raise ValueError(f"{n_cols} columns; at most {MAX_COLUMNS} pass through the driver")
    spark = matrix.sparkSession
    entries = matrix.groupBy(F.col(key), F.col(col).cast("int").alias("_at")).agg(
        F.sum(F.col(value).cast("double")).alias("_value")).filter(F.col("_value") != 0)
    # a row has at most n_cols entries
    packed = entries.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "_value"))).alias("_e"))
    rows = materialised(packed.select(key, F.col("_e._at").alias("at"), F.col("_e._value").alias("value")), "matrix")
    kind = rows.schema[key].dataType.simpleString()
    theta, v, residual = np.zeros(0), np.zeros((n_cols, 0)), np.zeros(0)
    if not rows.isEmpty():
        theta, v, residual = top_eigenvectors(lambda x: _gram_times(rows, x), n_cols, k, tol=tol, seed=seed, **options)
    lead = np.abs(v).argmax(axis=0) if v.size else np.zeros(0, int)
    v = v * np.sign(v[lead, np.arange(v.shape[1])])
    sigma = np.sqrt(theta)
    values = spark.createDataFrame(
        [(i + 1, float(s), float(r)) for i, (s, r) in enumerate(zip(sigma, residual))],
        "component int, sigma double, residual double")
    right = spark.createDataFrame(
        [(i, x) for i, x in enumerate(v.tolist())], f"{col} int, v array<double>")
    sent = spark.sparkContext.broadcast((v / sigma).tobytes())
    left = (rows.mapInArrow(_left(sent, v.shape, [key, "u"]), f"{key} {kind}, u array<double>") if len(sigma)
            else rows.select(key, F.array().cast("array<double>").alias("u")))
    return Svd(values, left, right)
