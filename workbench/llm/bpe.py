"""BPE encoding and decoding with a pair occurrence index.

The new words of a slice of texts lie in one array of symbols, linked within each word.
The index maps every mergeable pair to all its positions in that array. Ranks become
active when one of their pairs occurs; the active ranks are applied in ascending order,
each to all its positions at once, and every merge adds the two pairs that it makes to
their lists. Positions that an earlier merge has used up are skipped when met. As a merge
only makes symbols whose own merges come later, the order over all words is the order
within each word.

Defined results: a null or empty text has no ids and decodes to the empty text; special
strings inside a text have their own ids; rows are independent of each other.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import released, slices, text_or_empty, texts
from workbench.llm.tokenfiles import Vocabulary

# Bytes of text worked on at once, words indexed at once, words remembered by a task.
SLICE, INDEXED, REMEMBER = 1 << 20, 16_000, 400_000


def _positions(symbols: list[int], v: Vocabulary) -> dict[int, list[int]]:
    """The index: every mergeable pair's positions."""
    flat = np.array(symbols, np.int64)
    at = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
    pairs = flat[at] << v.SHIFT | flat[at + 1]
    order = np.argsort(pairs, kind="stable")
    found, first = np.unique(pairs[order], return_index=True)
    parts = zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)])
    ranked = at[order]
    return {pair: ranked[a:b].tolist() for pair, a, b in parts if pair in v.ranks}


def encode_words(words: list[str], v: Vocabulary) -> list[tuple[int, ...]]:
    """The ids of each word."""
    symbols, starts = v.symbol_rows(words)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks, shift = v.ranks, v.SHIFT
    where = _positions(symbols, v)
    active = [(*ranks[pair], pair) for pair in where]
    heapq.heapify(active)
    low = (1 << shift) - 1
    while active:
        _, union, pair = heapq.heappop(active)
        left, right = pair >> shift, pair & low
        for i in sorted(where.pop(pair)):
            if symbols[i] != left:
                continue
            j = after[i]
            if symbols[j] != right:
                continue
            symbols[i], symbols[j] = union, -2
            k = after[i] = after[j]
            before[k] = i
            if symbols[k] >= 0:
                new = union << shift | symbols[k]
                if new in where:
                    where[new].append(i)
                elif new in ranks:
                    where[new] = [i]
                    heapq.heappush(active, (*ranks[new], new))
            h = before[i]
            if symbols[h] >= 0:
                new = symbols[h] << shift | union
                if new in where:
                    where[new].append(h)
                elif new in ranks:
                    where[new] = [h]
                    heapq.heappush(active, (*ranks[new], new))
    out = []
    for s in starts:
        ids, i = [], s
        while symbols[i] != -1:
            ids.append(symbols[i])
            i = after[i]
        out.append(tuple(ids))
    return out


class Known:
    """The ids of the words met so far, in one array."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.number = {t: k for k, t in enumerate(self.v.special)}
        self.ids = np.array(list(self.v.special.values()), np.int32)
        self.first = np.arange(len(self.ids) + 1)

    def learn(self, words: list[str]) -> None:
        for k in range(0, len(words), INDEXED):
            part = words[k:k + INDEXED]
            ids = encode_words(part, self.v)
            ends = self.first[-1] + np.cumsum([len(x) for x in ids])
            self.number.update(zip(part, range(len(self.first) - 1, len(self.first) - 1 + len(part))))
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), np.int32)))
            self.first = np.concatenate((self.first, ends))

    def encode(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        size = self.first[at + 1] - self.first[at]
        ends = np.cumsum(size)
        return self.ids[np.arange(size.sum()) + np.repeat(self.first[at] - ends + size, size)]


def _encoder(path: str, load: Callable[[str], Vocabulary] = Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        known = Known(v)
        for batch in batches:
            _, ends = texts(batch.column(1))
            for a, b in slices(ends, SLICE):
                split = []
                for t in batch.column(1).slice(a, b - a):
                    words = []
                    for special, part in v.pieces(t.as_py()):
                        words += [part] if special else v.split.findall(part)
                    split.append(words)
                if len(known.number) > REMEMBER:
                    known.clear()
                known.learn(list(set().union(*split).difference(known.number)))
                ids = [known.encode(words) for words in split]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))],
                    ["id", "ids"])
    return run


def _decoder(path: str, sep: str, load: Callable[[str], Vocabulary] = Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(path)
        token = [v.token.get(i, "") for i in range(max(v.token) + 1)]
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            for a in range(0, len(column), 64):
                part = range(a, min(a + 64, len(column)))
                out = [sep.join(map(token.__getitem__, values[ends[k]:ends[k + 1]].tolist()))
                       for k in part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(out)),
                     batch.column(1).slice(a, len(out)), pa.array(out, pa.string())],
                    ["id", "ids", "decoded"])
    return run


def _both(path: str, sep: str):
    """The encoder's rows handed to the decoder in the same worker, with one vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = cache(Vocabulary)
        return _decoder(path, sep, load)(_encoder(path, load)(batches))
    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row. ``tokenizer``: path of a BPE file that every
    executor can read."""
    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(released(_encoder(tokenizer)), f"id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, *, sep: str = " ") -> DataFrame:
    """(id, ids, decoded): the tokens' strings joined by ``sep``, as the library does for
    a file that names no decoder."""
    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(
        released(_decoder(tokenizer, sep)), f"id {kind}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode, then decode, with digests: (doc_id, n_tokens, ids_sha256, decoded_sha256).
    A task does both in one Python worker: two would each hold a vocabulary and its batches."""
    rows, kind = _rows(docs, id_col, text_col)
    both = rows.mapInArrow(released(_both(tokenizer, " ")), f"id {kind}, ids array<int>, decoded string")
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.encode(joined, "utf-8"), 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))
