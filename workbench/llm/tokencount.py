"""Token counts by heap-and-linked-list byte-pair merging.

Each word of the tokenizer's split starts as a doubly linked list of its bytes' symbols.
A heap holds the mergeable adjacent pairs by (rank, position); popping the lowest and
joining the two nodes, until no pair is left, removes one symbol per merge. A word's
count is its symbols minus its merges, so no identifier is ever made.

Defined results: a null or empty text has 0 bytes and 0 tokens; a special string inside a
text counts 1; every row is counted by itself, whatever its doc_id or other columns.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import text_or_empty
from workbench.llm.tokenfiles import Remembered, Vocabulary

# Words remembered by a task, and the text length from which words are not listed at once.
REMEMBER = 400_000
LONG_TEXT = 1 << 20


def merged_length(symbols: list[int], ranks: dict[int, tuple[int, int]], shift: int) -> int:
    """The number of symbols left when no adjacent pair can be merged."""
    n = len(symbols)
    heap = []
    for i in range(n - 1):
        rank = ranks.get(symbols[i] << shift | symbols[i + 1])
        if rank:
            heap.append((rank[0], i, rank[1], symbols[i], symbols[i + 1]))
    if not heap:
        return n
    heapq.heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        _, i, union, left, right = heapq.heappop(heap)
        j = after[i]
        # an entry is stale once either of its symbols has changed
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        merges += 1
        symbols[i], symbols[j] = union, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get(union << shift | symbols[k])
            if rank:
                heapq.heappush(heap, (rank[0], i, rank[1], union, symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get(symbols[h] << shift | union)
            if rank:
                heapq.heappush(heap, (rank[0], h, rank[1], symbols[h], union))
    return n - merges


def _counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path)
        of_word = Remembered(lambda w: merged_length(v.symbols(w), v.ranks, v.SHIFT), REMEMBER)

        def of_text(text: str) -> int:
            total = 0
            for special, part in v.pieces(text):
                if special:
                    total += 1
                elif len(part) < LONG_TEXT:
                    total += sum(map(of_word.__getitem__, v.split.findall(part)))
                else:
                    total += sum(of_word[m.group()] for m in v.split.finditer(part))
            return total

        for batch in batches:
            column = batch.column(1)
            counts = np.fromiter((of_text(t.as_py()) for t in column), np.int64, len(column))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts)],
                ["id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, *, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row. ``tokenizer``: path of a BPE
    file that every executor can read."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_counter(tokenizer), f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
