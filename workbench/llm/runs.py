"""Periodic runs of words, caught online over dyadic blocks.

A run is a stretch of words with smallest period q (words q apart are identical), at least
``repeats`` * q and ``least`` words long, that no neighbouring word extends.

Words are appended page by page to a ``Catchers``. At every level L (``BASE``, then each
power of two above) the text is cut into blocks of L words. Once a block is complete its
catcher lives for the next two blocks: every appended word completes one suffix of L words,
which the level compares with the one catcher whose block began L to 2L - 1 words before it
(at the lowest level with both catchers that began up to 2L - 1 words before it). A run with
period q holds 2q neighbouring matches at distance q, so it holds a whole block of the level
of q, and that block's catcher meets its copy: no run is missed. Suffixes are compared by a
polynomial hash from running sums, one subtraction for a window of any length.

What a catcher finds is a square (block, period). Squares of neighbouring blocks with one
period merge; their exact stretch is found by comparing the words themselves to less than
one block beyond them, and a stretch that reaches the last word stays open and grows with the
next page. Squares inside a run whose period divides theirs are that run again and go, as do
squares between two runs of one period that no end of a run lines up with.

Defined results: null and blank texts have no words and no runs; rows that repeat, or lack
an id, are rows of their own; an empty table gives an empty result. A very long text is
split piece by piece: its words are integers (4 bytes a word, 16 for the running sums), and
only its distinct words are held as bytes. Columns are taken by name and others ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import text_or_empty

LEAST, REPEATS = 24, 3
# Lowest level: a run of LEAST words whose period is under 2 * BASE holds a block of BASE words.
BASE = 8
# Words of the first page (later ones are half of what came before, if that is more), bytes
# of text that are split at a time, bytes of text in a batch that a task returns.
PAGE, PIECE, BATCH = 1 << 16, 1 << 20, 1 << 23
BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
RUN_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, a piece of about ``size`` bytes at a time."""
    at = 0
    while at < len(data):
        cut = BLANK.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def word_numbers(data: bytes) -> np.ndarray:
    """Equal words have equal numbers, unlike words unlike ones."""
    seen: dict[bytes, int] = {}
    out, n = [], 0
    for words in pieces(data):
        out.append(np.fromiter(map(seen.setdefault, words, range(n, n + len(words))),
                               np.int32, len(words)))
        n += len(words)
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def _powers(base: int, first: int, n: int) -> np.ndarray:
    """base ** first, base ** (first + 1), ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = pow(base, first, 1 << 64)
    return np.multiply.accumulate(out)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last places of the maximal stretches of true values."""
    edge = np.flatnonzero(np.diff(equal, prepend=False, append=False))
    return edge[::2], edge[1::2]


def _prime_divisors(n: int) -> list[int]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return out + [n] if n > 1 else out


class Catchers:
    """Runs of a growing sequence of words (int32 numbers)."""

    def __init__(self, least: int = LEAST, repeats: int = REPEATS):
        if repeats < 3 or least < 3 * BASE:
            raise ValueError(f"runs of at least 3 repeats and {3 * BASE} words are caught")
        self.least, self.repeats = least, repeats
        self.n = 0
        self.words = np.zeros(0, np.int32)
        self.sums = np.zeros(1, np.uint64)  # running sums of word * ODD ** place
        self.back = np.zeros(0, np.uint64)  # ODD ** -place
        # stretches at distance q that reach the last word: q -> first place
        self.open: dict[int, int] = {}
        self.found: set[tuple[int, int]] = set()  # (start, period) of what is in runs or open
        self.runs: list[tuple[int, int, int]] = []  # (start, end, period), closed
        self.closed = np.zeros((0, 3), np.int64)  # the same as an array
        self.done: dict[int, int] = {}  # level -> suffixes compared so far

    def _need(self, q: int) -> int:
        """Matches at distance q that make a run."""
        return max(self.least - q, (self.repeats - 1) * q)

    def _hash(self, a: int, b: int, size: int) -> np.ndarray:
        """Hashes of the windows of ``size`` words that begin at a, ..., b - 1."""
        return (self.sums[a + size:b + size] - self.sums[a:b]) * self.back[a:b]

    def append(self, page: np.ndarray) -> None:
        """Advance all catchers by the words of ``page``."""
        if not len(page):
            return
        old = self.n
        mixed = page.astype(np.uint64) + np.uint64(1)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= _powers(_ODD, old, len(page))
        sums = np.add.accumulate(mixed)
        sums += self.sums[-1]
        self.words = np.concatenate((self.words, page)) if old else page
        self.sums = np.concatenate((self.sums, sums))
        self.back = np.concatenate((self.back, _powers(_ODD_INVERSE, old, len(page))))
        self.n = old + len(page)
        self._grow(old)
        size = BASE
        while self.repeats * size <= self.n:
            # a level that the text was too short for so far begins with the first word
            self._level(size, self.done.get(size, 0))
            self.done[size] = self.n - size + 1
            size *= 2

    def _grow(self, old: int) -> None:
        """Compare the new words with those an open period before them."""
        for q, start in list(self.open.items()):
            equal = self.words[old:] == self.words[old - q:self.n - q]
            if equal.all():
                continue
            del self.open[q]
            self._close(start, old + int(equal.argmin()), q)

    def _close(self, start: int, end: int, q: int) -> None:
        if end - start - q >= self._need(q) and self._primitive(start, q):
            self.runs.append((start, end, q))

    def _primitive(self, start: int, q: int) -> bool:
        first = self.words[start:start + q]
        return not any(np.array_equal(first, self.words[start + q // d:start + q // d + q])
                       for d in _prime_divisors(q))

    def _known(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the runs of ``least`` words and more so far, by start."""
        if len(self.closed) < len(self.runs):
            added = np.array(self.runs[len(self.closed):], np.int64)
            self.closed = np.concatenate((self.closed, added))
        now = np.array([(s, self.n, q) for q, s in self.open.items()
                        if self.n - s - q >= self._need(q)], np.int64).reshape(-1, 3)
        a = np.concatenate((self.closed, now))
        a = a[a[:, 1] - a[:, 0] >= least]
        a = a[np.argsort(a[:, 0], kind="stable")]
        return a[:, 0], a[:, 1], a[:, 2]

    def _level(self, size: int, first: int) -> None:
        """Compare the suffixes that begin at ``first`` and later with their catchers."""
        last = self.n - size + 1
        if size > BASE:
            first = max(first, size)
            if first >= last:
                return
            block = np.arange(first // size, (last - 1) // size + 1) - 1
            heads = np.repeat(self._heads(block, size), size)
            heads = heads[first - (block[0] + 1) * size:][:last - first]
            at = np.flatnonzero(self._hash(first, last, size) == heads) + first
            if len(at):
                start = (at // size - 1) * size
                self._catch(size, start, at - start)
            return
        if first >= last:
            return
        here = self._hash(first, last, size)
        low = first // size
        block = np.arange(low, (last - 1) // size + 1)
        own = np.repeat(self._heads(block, size), size)[first - low * size:][:last - first]
        before = self._heads(block - 1, size)
        prior = np.repeat(before, size)[first - low * size:][:last - first]
        at = np.flatnonzero((here == own) | (here == prior)) + first
        if not len(at):
            return
        both_at, both_start = [], []
        for back, same in ((0, own), (1, prior)):
            start = (at // size - back) * size
            good = (here[at - first] == same[at - first]) & (start >= 0) & (at > start)
            both_at.append(at[good])
            both_start.append(start[good])
        at, start = np.concatenate(both_at), np.concatenate(both_start)
        # small periods first: their runs tell which larger ones are the same run again
        period = at - start
        for q in np.unique(period).tolist():
            self._catch(size, np.sort(start[period == q]), np.int64(q))

    def _heads(self, block: np.ndarray, size: int) -> np.ndarray:
        at = np.maximum(block, 0) * size
        return (self.sums[at + size] - self.sums[at]) * self.back[at]

    def _catch(self, size: int, start: np.ndarray, period: np.ndarray) -> None:
        """Merge squares (a block at ``start`` and its copy ``period`` later) into stretches."""
        period = np.broadcast_to(period, start.shape)
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + size)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(start)) - 1
        a, b, q = start[begin], start[end] + size, period[begin]
        keep = ~self._inside(a, b + q, q) & ~self._between(a, q, size)
        for a, b, q in zip(a[keep].tolist(), b[keep].tolist(), q[keep].tolist()):
            if self.open.get(q, self.n) > a:
                self._measure(a, b, q)

    def _inside(self, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Squares [a, b) within a run whose period divides q and is smaller."""
        starts, ends, periods = self._known(2 * BASE)
        out = np.zeros(len(a), bool)
        if len(starts):
            # of the runs long enough to hold such a square the last to begin is the one
            long = ends - starts >= (b - a).min()
            starts, ends, periods = starts[long], ends[long], periods[long]
        if len(starts):
            k = np.searchsorted(starts, a, side="right") - 1
            p = periods[k]
            out = (k >= 0) & (ends[k] >= b) & (q % p == 0) & (q > p)
        return out

    def _between(self, a: np.ndarray, q: np.ndarray, size: int) -> np.ndarray:
        """Squares whose halves lie in two runs of one period that are not shifted by q at
        either end: their stretch is shorter than the overlap of two runs can be."""
        starts, ends, periods = self._known(size)
        if not len(starts):
            return np.zeros(len(a), bool)
        i = np.searchsorted(starts, a, side="right") - 1
        j = np.searchsorted(starts, a + q, side="right") - 1
        held = (i >= 0) & (ends[i] >= a + size) & (ends[j] >= a + q + size) & (ends[j] < self.n)
        return (held & (i != j) & (periods[i] == periods[j]) & (periods[i] < q)
                & (starts[j] - starts[i] != q) & (ends[j] - ends[i] != q))

    def _measure(self, a: int, b: int, q: int) -> None:
        """Follow the matches at distance q between places a and b to both ends, word by word."""
        equal = self.words[a:b] == self.words[a + q:b + q]
        if not equal.all():  # two windows with one hash
            for x, y in zip(*_stretches(equal)):
                self._measure(a + int(x), a + int(y), q)
            return
        step = BASE
        while a:
            low = max(a - step, 0)
            equal = self.words[low:a] == self.words[low + q:a + q]
            same = len(equal) if equal.all() else int(equal[::-1].argmin())
            a -= same
            if same < len(equal):
                break
            step *= 2
        step = BASE
        while b < self.n - q:
            high = min(b + step, self.n - q)
            equal = self.words[b:high] == self.words[b + q:high + q]
            same = len(equal) if equal.all() else int(equal.argmin())
            b += same
            if same < len(equal):
                break
            step *= 2
        if (a, q) in self.found:
            return
        if b + q == self.n:
            self.found.add((a, q))
            self.open[q] = a
        elif b - a >= self._need(q):
            self.found.add((a, q))
            self._close(a, b + q, q)

    def result(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run of the words so far, in order."""
        closed = len(self.runs)
        for q, start in self.open.items():
            self._close(start, self.n, q)
        out = [(s, e - s, q) for s, e, q in self.runs]
        del self.runs[closed:]  # what is open may still grow
        return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(words: np.ndarray, least: int = LEAST, repeats: int = REPEATS,
            page: int = PAGE) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers, in order."""
    if len(words) < least:
        return []
    catchers, k = Catchers(least, repeats), 0
    while k < len(words):
        end = k + max(page, k // 2)
        catchers.append(words[k:end])
        k = end
    return catchers.result()


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    at = np.array(runs, np.int64).reshape(-1, 3)
    np.add.at(change, at[:, 0] + at[:, 2], 1)
    np.add.at(change, at[:, 0] + at[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def collapse(data: bytes, keep: np.ndarray | None) -> bytes:
    """The kept words (all, for None) joined by one space."""
    out, n = [], 0
    for words in pieces(data):
        if keep is not None:
            mask = keep[n:n + len(words)]
            n += len(words)
            words = [w for w, stays in zip(words, mask.tolist()) if stays]
        if words:
            out.append(b" ".join(words))
    return b" ".join(out)


def _finder(least: int, repeats: int):
    """mapInArrow function from (id, text) to (id, n_words, runs, collapsed)."""
    names = ["id", "n_words", "runs", "collapsed"]

    def table(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        n, runs, kept = zip(*rows)
        found = [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(found, RUN_TYPE), pa.array(kept, pa.string())],
            names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, rows = 0, 0, []
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_buffer().to_pybytes()
                words = word_numbers(data)
                runs = runs_of(words, least, repeats)
                keep = kept_words(len(words), runs) if runs else None
                rows.append((len(words), runs, collapse(data, keep)))
                size += len(data)
                if size > BATCH or k + 1 == batch.num_rows:
                    yield table(batch.column(0).slice(first, k + 1 - first), rows)
                    first, size, rows = k + 1, 0, []
    return run


def find_runs(docs: DataFrame, *, least: int = LEAST, repeats: int = REPEATS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start, then period
    (places and lengths in words), and its text without what repeats."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_finder(least, repeats),
                          f"id {kind}, n_words bigint, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", "doc_id")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equals."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
        .otherwise(best))


def _planter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for name, text in zip(batch.column(0), batch.column(1)):
            h = zlib.crc32(str(name.as_py()).encode()) if name.is_valid else 1
            words = text.as_buffer().to_pybytes().split() if h % 10 == 0 else []
            if not words:
                out.append(text.as_py())
                continue
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            unit = words[a:a + p]
            words[a:] = (unit * (-(-(n - a) // p)))[:n - a]
            out.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])


def with_planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where the texts whose crc32 of the decimal doc_id is divisible by ten go on
    periodically from one of their words: rows with known repeats, for queries and tests."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(_planter, rows.schema)
