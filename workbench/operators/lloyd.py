"""K-means steps over packed feature matrices, for all fits of a sweep together.

The start is Spark ML's (k-means||, seeded), drawn from the same rows with the same numbers
(``operators.kmeans_start``). The rows are packed once, rows that lie near each other side by
side in groups, each with the box that it fills. A step reads the matrices: a centre that is
nowhere in a group's box as near as another one is left out for the group's rows, a task adds
up its rows of each cluster, the sums of tasks meet, and the driver holds the centres only. The
rules are those of Spark ML: equal distances go to the lower cluster, a cluster without rows
keeps its centre, and a fit ends when no centre moved by more than ``tol``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from types import SimpleNamespace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.functions.bounded import collected

# Bytes of the rows that are put in order together and of one matrix (a large one is copied
# several times on its way to Python), rows of a group, groups whose boxes are looked at
# together first, and the least share of the rows that are split.
ORDER_BYTES, MATRIX_BYTES, GROUP_ROWS, GROUPS, LEAST_SHARE = 16_000_000, 1_000_000, 512, 16, 32
# Rows whose distances to all centres are held at a time (in a core's cache).
AT_ONCE = 256
# A step is a few milliseconds of work for a part of rows and many more to start a task, so a
# task takes several parts: up to FEW_TASKS parts one each, beyond that at most PARTS_OF_TASK.
FEW_TASKS, PARTS_OF_TASK = 24, 20
# Sums of tasks that meet in one task.
MERGED = 256


class Groups(NamedTuple):
    """Rows in groups that lie near each other, and the corners of the groups' boxes."""

    rows: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _matrices(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def grouped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, ends): an order of the rows in which each group of at most ``GROUP_ROWS`` is
    a box of few others: halves along the widest column, again and again."""
    order, ends, open_ = np.arange(len(x)), [], [(0, len(x))]
    while open_:
        a, b = open_.pop()
        if b - a <= GROUP_ROWS:
            order[a:b].sort()
            ends.append(b)
            continue
        own, cut = x[order[a:b]], (b - a) // 2
        column = own[:, (own.max(axis=0) - own.min(axis=0)).argmax()]
        middle = np.partition(column, cut)[cut]
        # rows with the middle's value stay together, unless a half would have hardly any rows
        ends_of = [n for n in ((column < middle).sum(), (column <= middle).sum()) if min(n, b - a - n) * LEAST_SHARE >= b - a]
        cut = int(min(ends_of, key=lambda n: abs(n - cut), default=cut))
        order[a:b] = order[a:b][np.argpartition(column, cut)]
        open_ += [(a + cut, b), (a, a + cut)]
    return order, np.array(ends)


def packed(df: DataFrame, features: str) -> DataFrame:
    """(width, rows, ends, at): the feature vectors as binary matrices of doubles in groups that
    end at ``ends``, and of each row its part of ``df`` times 2^33 and its place there. Several parts
    go into one task. In memory and on disk; the caller unpersists it."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, size = [], [], 0

        def finish() -> Iterator[pa.RecordBatch]:
            x, places = np.concatenate(held), np.concatenate(at)
            if not np.isfinite(x).all():
                raise ValueError("a feature that is no finite number")
            order, ends = grouped(x)
            # whole groups, as many as a matrix holds
            matrix = ends * x.shape[1] * 8 // MATRIX_BYTES
            a = 0
            for own in np.split(ends, np.flatnonzero(np.diff(matrix)) + 1):
                rows = order[a:own[-1]]
                yield pa.RecordBatch.from_pydict({
                    "width": pa.array([x.shape[1]], pa.int32()), "rows": pa.array([x[rows].tobytes()], pa.binary()),
                    "ends": pa.array([(own - a).astype(np.int32).tobytes()], pa.binary()),
                    "at": pa.array([places[rows].tobytes()], pa.binary())})
                a = own[-1]
        for batch in batches:
            if batch.num_rows:
                x = _matrices(batch.column("x"))
                held.append(x.copy())
                at.append(batch.column("at").to_numpy().copy())
                size += x.nbytes
                if size >= ORDER_BYTES:
                    yield from finish()
                    held, at, size = [], [], 0
        if held:
            yield from finish()
    arrays = df.select(vector_to_array(features).alias("x"), F.monotonically_increasing_id().alias("at"))
    few = arrays.coalesce(step_tasks(arrays.rdd.getNumPartitions()))
    return few.mapInArrow(pack, "width int, rows binary, ends binary, at binary").persist(StorageLevel.MEMORY_AND_DISK)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Groups, pa.RecordBatch]]:
    """The matrices of a task, each with the row it came in."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            x = np.frombuffer(row.column("rows")[0].as_buffer()).reshape(-1, row.column("width")[0].as_py())
            ends = np.frombuffer(row.column("ends")[0].as_buffer(), np.int32)
            starts = np.concatenate(([0], ends[:-1]))
            yield Groups(x, ends, np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)), row


def added(matrices: DataFrame, run: Callable[[Groups], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums over all matrices of the arrays that ``run`` gives for one."""
    def laid(batches: Iterator[pa.RecordBatch], each: Callable) -> Iterator[pa.RecordBatch]:
        total = None
        for arrays in each(batches):
            total = arrays if total is None else [a + b for a, b in zip(total, arrays)]
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([[a.astype(float).tobytes() for a in total]],
                                                               pa.list_(pa.binary()))})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return laid(batches, lambda held: (run(g) for g, _ in unpacked(held)))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return laid(batches, lambda held: ([np.frombuffer(x.as_buffer()) for x in row.values]
                                           for b in held for row in b.column("sums")))
    sums, parts = matrices.select("width", "rows", "ends").mapInArrow(first, "sums array<binary>"), matrices.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // MERGED)
        sums = sums.repartition(parts).mapInArrow(again, "sums array<binary>")
    found = collected(sums, 1)
    return [np.frombuffer(x) for x in found[0]["sums"]] if found else []


def step_tasks(parts: int) -> int:
    """Tasks of a step over matrices in so many parts, whatever runs them."""
    return max(1, min(parts, FEW_TASKS), -(-parts // PARTS_OF_TASK))


def nearest_center(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, equal ones to the lower number. The constant of a row,
    its own length, takes no part; rows and centres are moved to the centres' mean first."""
    mid = centers.mean(axis=0)
    around = centers - mid
    half, turned = (around * around).sum(axis=1) / 2, np.ascontiguousarray(around.T)
    out, space = np.empty(len(x), np.int64), np.empty((min(len(x), AT_ONCE), len(centers)))
    for at in range(0, len(x), AT_ONCE):
        part = x[at:at + AT_ONCE] - mid
        far = np.matmul(part, turned, out=space[:len(part)])
        np.subtract(half, far, out=far)
        far.argmin(axis=1, out=out[at:at + AT_ONCE])
    return out


def _left(low: np.ndarray, high: np.ndarray, around: np.ndarray, half: np.ndarray) -> np.ndarray:
    """(boxes, centres): False for a centre that is farther from every point of the box than the
    one nearest to the box's middle. The room for rounding keeps equal ones."""
    mid, reach = (low + high) / 2, (high - low) / 2
    lead = mid @ around.T
    lead -= half
    best = lead.argmax(axis=1)
    ours, scale = np.arange(len(mid)), np.abs(mid).max() + np.abs(around).max() + reach.max()
    # how much nearer a centre can be than the leading one, at the corner that is best for it
    lead -= lead[ours, best][:, None]
    for f in range(around.shape[1]):
        lead += reach[:, f, None] * np.abs(around[None, :, f] - around[best, f, None])
    return lead >= -1e-12 * around.shape[1] * scale * scale


def nearest_of_groups(g: Groups, centers: np.ndarray) -> np.ndarray:
    """``nearest_center`` of the rows of groups, without the centres that no row of a group can be
    nearest to."""
    mid = centers.mean(axis=0)
    around, x = centers - mid, g.rows - mid
    half = (around * around).sum(axis=1) / 2
    low, high, out = g.low - mid, g.high - mid, np.empty(len(x), np.int64)
    a = 0
    for first in range(0, len(low), GROUPS):
        some = slice(first, first + GROUPS)
        few = np.flatnonzero(_left(low[some].min(axis=0)[None], high[some].max(axis=0)[None], around, half)[0])
        here, h = around[few], half[few]
        for own, b in zip(_left(low[some], high[some], here, h), g.ends[some]):
            which = np.flatnonzero(own)
            if len(which) == 1:
                out[a:b] = few[which[0]]
            else:
                far = x[a:b] @ here[which].T
                np.subtract(h[which], far, out=far)
                out[a:b] = few[which[far.argmin(axis=1)]]
            a = b
    return out


def costs(g: Groups, centers: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its centre, terms added in order of the columns."""
    out = np.zeros(len(g.rows))
    for f in range(g.rows.shape[1]):
        off = g.rows[:, f] - centers[own, f]
        out += off * off
    return out


def costs_of(matrices: DataFrame, fits: Sequence[np.ndarray]) -> list[float]:
    """For each fit's centres the sum of the rows' squared distances to the nearest of them."""
    def run(g: Groups) -> list[np.ndarray]:
        return [np.array([costs(g, c, nearest_of_groups(g, c)).sum() for c in fits])]
    return [float(x) for x in (added(matrices, run) or [np.zeros(len(fits))])[0]]


def counts_of(matrices: DataFrame, fits: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For each fit's centres the number of rows that each is nearest to."""
    def run(g: Groups) -> list[np.ndarray]:
        return [np.bincount(nearest_of_groups(g, c), minlength=len(c)) for c in fits]
    return added(matrices, run) or [np.zeros(len(c)) for c in fits]


def _sums(fits: Sequence[np.ndarray]) -> Callable[[Groups], list[np.ndarray]]:
    """Rows and sum of rows of each cluster, (1 + width) numbers each, for each fit."""
    def run(g: Groups) -> list[np.ndarray]:
        out = []
        for centers in fits:
            own, k = nearest_of_groups(g, centers), len(centers)
            out.append(np.concatenate([np.bincount(own, minlength=k),
                                       *(np.bincount(own, g.rows[:, f], k) for f in range(centers.shape[1]))]))
        return out
    return run


def moved_together(matrices: DataFrame, fits: Sequence[np.ndarray], max_iter: int, tol: float
                   ) -> list[tuple[np.ndarray, float, int]]:
    """(centres, cost, steps) of each fit: the centres after at most ``max_iter`` steps, and the
    cost of the centres that the last step began with, as Spark ML states it."""
    now = [np.array(c, dtype=float) for c in fits]
    before, steps, open_ = list(now), [0] * len(now), list(range(len(now)))
    for _ in range(max_iter):
        sums = added(matrices, _sums([now[i] for i in open_]))
        on = []
        for i, flat in zip(open_, sums):
            found = flat.reshape(1 + now[i].shape[1], -1)
            there = found[0] > 0
            before[i], now[i], steps[i] = now[i], now[i].copy(), steps[i] + 1
            now[i][there] = (found[1:, there] / found[0, there]).T
            if not (((now[i] - before[i]) ** 2).sum(axis=1) <= tol * tol).all():
                on.append(i)
        open_ = on
        if not open_:
            break
    cost = costs_of(matrices, before) if max_iter else [0.0] * len(now)
    return list(zip(now, cost, steps))


def moved(matrices: DataFrame, centers: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, float, int]:
    """``moved_together`` of one fit."""
    return moved_together(matrices, [centers], max_iter, tol)[0]


class LloydModel(Model):
    """Centres and cost of a fit; adds the number of the nearest centre."""

    def __init__(self, centers: np.ndarray, cost: float, steps: int, features: str, prediction: str):
        super().__init__()
        self._centers, self._features, self._prediction = centers, features, prediction
        self.summary = SimpleNamespace(trainingCost=cost, numIter=steps, k=len(centers))

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802 (as Spark ML names it)
        return list(self._centers)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        centers = self._centers

        @F.arrow_udf("int")
        def own(x: pa.Array) -> pa.Array:
            return pa.array(nearest_center(_matrices(x), centers) if len(x) else [], pa.int32())
        return dataset.withColumn(self._prediction, own(vector_to_array(self._features)))


def fitted(matrices: DataFrame, ks: Sequence[int], features: str, prediction: str, *, max_iter: int, tol: float,
           seed: int) -> list[LloydModel]:
    """A model for each k, all in the same passes over the matrices."""
    from workbench.operators.kmeans_start import started
    return [LloydModel(*fit, features, prediction)
            for fit in moved_together(matrices, started(matrices, ks, seed), max_iter, tol)]


class Lloyd(Estimator):
    """K-means with the start, the rules and the parameters of Spark ML's ``KMeans``."""

    def __init__(self, k: int, features: str, prediction: str, *, max_iter: int, tol: float, seed: int):
        super().__init__()
        self._k, self._names = k, (features, prediction)
        self._rules = {"max_iter": max_iter, "tol": tol, "seed": seed}

    def _fit(self, dataset: DataFrame) -> LloydModel:
        matrices = packed(dataset, self._names[0])
        try:
            return fitted(matrices, [self._k], *self._names, **self._rules)[0]
        finally:
            matrices.unpersist()
