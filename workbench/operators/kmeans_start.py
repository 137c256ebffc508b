"""The start of k-means: Spark ML's k-means||, over packed matrices.

Spark ML keeps the rows and their costs for each fit and measures every row against every new
centre. Here the passes read the matrices of ``operators.lloyd``, which leave most centres out.
The same rows are drawn: the numbers come from Spark's own generators, seeded by step and part
and taken in the order of a part's rows, so that a seeded fit has the start that Spark ML gives it.
All fits of a sweep share the passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from workbench.functions.bounded import collected, only_row
from workbench.functions.partitions import MAX_PARTS as SPREAD_PARTS
from workbench.operators import lloyd

# Spark's values: passes that draw candidates, steps over the weighted candidates.
INIT_STEPS, LOCAL_STEPS = 2, 30
# Bits of a row's place in its part, the parts that a table may have, and those whose numbers a task keeps.
PLACE_BITS, MAX_PARTS, KNOWN_PARTS = 33, 4 * SPREAD_PARTS, 16
_32, _48, _64 = (1 << 32) - 1, (1 << 48) - 1, (1 << 64) - 1


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


class JavaRandom:
    """java.util.Random, of which these draws are used."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & _48

    def next(self, bits: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & _48
        return _signed(self.state >> (48 - bits), 32)

    def integer(self, bound: int | None = None) -> int:
        if bound is None:
            return self.next(32)
        r = self.next(31)
        if bound & (bound - 1) == 0:
            return (bound * r) >> 31
        u, r = r, r % bound
        while u - r + bound - 1 >= 1 << 31:
            u = self.next(31)
            r = u % bound
        return r

    def long(self) -> int:
        return _signed((self.next(32) << 32) + self.next(32), 64)

    def double(self) -> float:
        return ((self.next(26) << 27) + self.next(27)) * 2.0 ** -53


def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 of whole words of four bytes."""
    h = seed
    for at in range(0, len(data), 4):
        w = int.from_bytes(data[at:at + 4], "little") * 0xCC9E2D51 & _32
        h ^= ((w << 15 | w >> 17) & _32) * 0x1B873593 & _32
        h = ((h << 13 | h >> 19) & _32) * 5 + 0xE6546B64 & _32
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & _32
    h = (h ^ h >> 13) * 0xC2B2AE35 & _32
    return h ^ h >> 16


def hashed_seed(seed: int) -> int:
    """The state that Spark's XORShiftRandom starts from."""
    data = (seed & _64).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


class XorShift(JavaRandom):
    """Spark's XORShiftRandom."""

    def __init__(self, seed: int):
        self.state = hashed_seed(seed)

    def next(self, bits: int) -> int:
        s = self.state
        s ^= (s << 21) & _64
        s ^= s >> 35
        self.state = s = s ^ (s << 4) & _64
        return _signed(s & ((1 << bits) - 1), 32)


def _stepped(s: np.ndarray) -> np.ndarray:
    s = s ^ s << np.uint64(21)
    s = s ^ s >> np.uint64(35)
    return s ^ s << np.uint64(4)


def uniforms(seed: int, n: int) -> np.ndarray:
    """The first ``n`` doubles of XorShift(seed). A state is a linear function of an earlier one,
    bit by bit: what takes a state ``m`` steps on is looked up byte by byte."""
    # states that a single bit becomes after as many steps as there are states
    bits = _stepped(np.uint64(1) << np.arange(64, dtype=np.uint64))
    states = _stepped(np.array([hashed_seed(seed)], np.uint64))

    def ahead(s: np.ndarray) -> np.ndarray:
        out = np.zeros_like(s)
        for byte in range(8):
            table = np.zeros(256, np.uint64)
            for b in range(8):
                table[1 << b:2 << b] = table[:1 << b] ^ bits[8 * byte + b]
            out ^= table[(s >> np.uint64(8 * byte)) & np.uint64(255)]
        return out
    while len(states) < 2 * n:
        states, bits = np.concatenate([states, ahead(states)]), ahead(bits)
    high, low = states[0:2 * n:2] & np.uint64((1 << 26) - 1), states[1:2 * n:2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(float) * 2.0 ** -53


def first_row(sizes: dict[int, int], seed: int) -> tuple[int, int]:
    """(part, place) of the row that Spark's takeSample(false, 1, seed) takes from parts of these sizes."""
    n, rand, parts = sum(sizes.values()), JavaRandom(seed), max(sizes) + 1
    if n <= 1:
        return next((p, 0) for p, size in sizes.items() if size)
    # the share of rows to draw for one at least, almost surely
    gamma = -np.log(1e-4) / n
    share = min(1.0, max(1e-10, 1 / n + gamma + np.sqrt(gamma * gamma + 2 * gamma / n)))
    while True:
        seeds, drawn = JavaRandom(rand.integer()), []
        for part in range(parts):
            own, size, at = XorShift(seeds.long()), sizes.get(part, 0), 0
            if not size:
                continue
            if share > 0.4:
                drawn += [(part, i) for i in range(size) if share >= 1 or own.double() <= share]
                continue
            while True:
                at += int(np.log(max(own.double(), 5e-11)) / np.log1p(-share))
                if at >= size:
                    break
                drawn.append((part, at))
                at += 1
        if drawn:
            break
    for i in range(len(drawn) - 1, 0, -1):
        j = rand.integer(i + 1)
        drawn[i], drawn[j] = drawn[j], drawn[i]
    return drawn[0]


def _row_at(matrices: DataFrame, at: int) -> np.ndarray:
    """The row at a place."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, row in lloyd.unpacked(batches):
            for i in np.flatnonzero(_places(row) == at):
                yield pa.RecordBatch.from_pydict({"x": pa.array([g.rows[i].tolist()], pa.list_(pa.float64()))})
    return np.array(only_row(matrices.mapInArrow(find, "x array<double>").repartition(1))["x"])


def _places(row: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(row.column("at")[0].as_buffer(), np.int64)


def _numbers(at: np.ndarray, seed: int, step: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Spark's number for each row: those of a part come from one generator in the order of its
    rows. ``known``: numbers of parts that the next matrix may hold rows of too."""
    out, part = np.empty(len(at)), at >> PLACE_BITS
    order = np.argsort(part, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        places = at[rows] & ((1 << PLACE_BITS) - 1)
        own, last = int(part[rows[0]]), int(places.max())
        if last >= len(known.get(own, ())):
            while len(known) >= KNOWN_PARTS:
                del known[next(iter(known))]
            known.pop(own, None)
            known[own] = uniforms(_signed(seed ^ step << 16 ^ own, 32), 2 * last + 1)
        out[rows] = known[own][places]
    return out


def _drawn(matrices: DataFrame, fits: list[np.ndarray], ks: Sequence[int], seed: int, step: int) -> list[np.ndarray]:
    """For each fit rows drawn with a chance of 2k times their share of its cost, in the order of the rows."""
    cost = lloyd.costs_of(matrices, fits)
    shares = [2.0 * k / c if c > 0 else 0.0 for k, c in zip(ks, cost)]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for g, row in lloyd.unpacked(batches):
            at = _places(row)
            numbers = _numbers(at, seed, step, known)
            for i, (centers, share) in enumerate(zip(fits, shares)):
                own = np.flatnonzero(numbers < lloyd.costs(g, centers, lloyd.nearest_of_groups(g, centers)) * share)
                yield pa.RecordBatch.from_pydict({
                    "fit": pa.array(np.full(len(own), i), pa.int32()), "at": pa.array(at[own]),
                    "x": pa.array(g.rows[own].tolist(), pa.list_(pa.float64()))})
    # 2k rows for a fit on average, and hardly ever four times as many
    table = matrices.mapInArrow(draw, "fit int, at bigint, x array<double>").repartition(1)
    rows = sorted(collected(table, sum(8 * k + 1000 for k in ks)), key=lambda r: r["at"])
    return [np.array([r["x"] for r in rows if r["fit"] == i]).reshape(-1, centers.shape[1])
            for i, centers in enumerate(fits)]


def _sizes(matrices: DataFrame) -> dict[int, int]:
    """Rows of each part."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("at"):
                part, n = np.unique(np.frombuffer(at.as_buffer(), np.int64) >> PLACE_BITS, return_counts=True)
                yield pa.RecordBatch.from_pydict({"part": pa.array(part), "n": pa.array(n)})
    found = matrices.select("at").mapInArrow(count, "part bigint, n bigint").groupBy("part").sum("n")
    return {part: n for part, n in collected(found, MAX_PARTS)}


def _far(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points))
    for f in range(points.shape[1]):
        out += (points[:, f] - center[f]) ** 2
    return out


def plus_plus(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k centres of the weighted points: Spark's LocalKMeans."""
    rand, last = JavaRandom(0), len(points) - 1

    def place(sums: np.ndarray, r: float) -> int:
        """The first point at which the running sum reaches ``r``."""
        return min(int(np.searchsorted(sums, r, side="left")), last) if r > 0 else 0
    centers = np.empty((k, points.shape[1]))
    sums = np.cumsum(weights)
    centers[0] = points[place(sums, rand.double() * sums[-1])]
    cost = _far(points, centers[0])
    for i in range(1, k):
        sums = np.cumsum(weights * cost)
        centers[i] = points[place(sums, rand.double() * sums[-1])]
        cost = np.minimum(cost, _far(points, centers[i]))
    closest = np.full(len(points), -1)
    for _ in range(LOCAL_STEPS):
        far = np.stack([_far(points, c) for c in centers], axis=1)
        own = far.argmin(axis=1)
        settled, closest = (own == closest).all(), own
        n = np.bincount(own, weights, k)
        for f in range(points.shape[1]):
            total = np.bincount(own, weights * points[:, f], k)
            centers[n > 0, f] = total[n > 0] * (1.0 / n[n > 0])
        for j in np.flatnonzero(n == 0):
            centers[j] = points[rand.integer(len(points))]
        if settled:
            break
    return centers


def started(matrices: DataFrame, ks: Sequence[int], seed: int) -> list[np.ndarray]:
    """For each k the centres that Spark ML's k-means|| starts from: fewer where fewer rows differ."""
    sizes = _sizes(matrices)
    if not sizes:
        raise ValueError("no rows to fit k-means on")
    seed = XorShift(seed).integer()
    part, place = first_row(sizes, seed)
    fits = [_row_at(matrices, (part << PLACE_BITS) + place)[None]] * len(ks)
    for step in range(INIT_STEPS):
        fits = [np.concatenate(both) for both in zip(fits, _drawn(matrices, fits, ks, seed, step))]
    for i, centers in enumerate(fits):
        _, first = np.unique(centers, axis=0, return_index=True)
        fits[i] = centers[np.sort(first)]
    many = [i for i, k in enumerate(ks) if len(fits[i]) > k]
    for i, weights in zip(many, lloyd.counts_of(matrices, [fits[i] for i in many]) if many else []):
        fits[i] = plus_plus(fits[i], weights, ks[i])
    return fits
