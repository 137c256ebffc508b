"""SimHash near-duplicates with sharded BK-trees.

Fingerprints: each document's word shingles are hashed, and a bit is set where over half
of the hashes have it. Equal fingerprints are one node.

Search: a node's 64 bits are cut into ``radius`` + 2 blocks (more for very large corpora);
two fingerprints within the radius agree on at least two of them, so a shard is a choice
of blocks with their bits, and every close pair meets in some shard, without loss. Each
shard has a BK-tree: a child hangs from its parent by their Hamming distance, and a query
follows only edges within the radius of its own distance. A shard's tree meets its queries
by the shuffle that makes the shard: broadcasting all trees would send every fingerprint
to every executor. A shard of over ``tree_size`` nodes is salted into several trees in
different tasks, each queried by all nodes of the shard. Of the pairs found in a tree only
those that join two groups not yet joined there are passed on, so links stay linear in the
nodes; components over all links are the result.

Defined results: null and blank texts have fingerprint zero, linked like any other; rows
that repeat share a component; the component's id is its smallest doc_id, nulls ignored
unless there is no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import first_of, numbered, plain, stored, text_or_empty
from workbench.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
TREE_SIZE, PER_SHARD, PIECE = 2_048, 6, 50_000
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as an unsigned integer."""
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = [0, *ends[:n - 1].tolist()]
    stop = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, PIECE):
        h = np.array([digest(joined[a:b], SEED)
                      for a, b in zip(begin[k:k + PIECE], stop[k:k + PIECE])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprinter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                ["r", "id", "fp"])
    return run


class Tree:
    """A BK-tree of integers with the groups that the links found so far make."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []
        self.group: list[int] = []

    def _root(self, k: int) -> int:
        while self.group[k] != k:
            self.group[k] = self.group[self.group[k]]
            k = self.group[k]
        return k

    def add(self, x: int) -> int:
        """The node of x, new if need be."""
        at = 0
        while self.value:
            d = (x ^ self.value[at]).bit_count()
            if d == 0:
                return at
            below = self.children[at]
            if d not in below:
                below[d] = len(self.value)
                break
            at = below[d]
        self.value.append(x)
        self.children.append({})
        self.group.append(len(self.group))
        return len(self.value) - 1

    def near(self, x: int, radius: int) -> Iterator[int]:
        """Nodes within ``radius`` of x."""
        value, children = self.value, self.children
        open_nodes = [0] if value else []
        while open_nodes:
            at = open_nodes.pop()
            d = (x ^ value[at]).bit_count()
            if d <= radius:
                yield at
            open_nodes += [c for e, c in children[at].items() if d - radius <= e <= d + radius]

    def links(self, x: int, radius: int) -> Iterator[int]:
        """Values within ``radius`` of x, one for each group not yet joined with x."""
        own = self.add(x)
        for k in self.near(x, radius):
            a, b = self._root(own), self._root(k)
            if a != b:
                self.group[max(a, b)] = min(a, b)
                yield self.value[k]


def _searcher(radius: int):
    """mapInArrow function over rows (shard, key, piece, is_node, fp), each (shard, key,
    piece) together with its nodes first, to links (a, b)."""
    full = (1 << 64) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, Tree()
        for batch in batches:
            found = []
            columns = [c.to_pylist() for c in batch.columns]
            for shard, key, piece, is_node, fp in zip(*columns):
                if (shard, key, piece) != held:
                    held, tree = (shard, key, piece), Tree()
                x = fp & full
                if is_node:
                    found += ((x, y) for y in tree.links(x, radius))
                else:
                    # a guest is linked but does not enter the tree
                    joined = set()
                    for k in tree.near(x, radius):
                        g = tree._root(k)
                        if g not in joined:
                            joined.add(g)
                            found.append((x, tree.value[k]))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    return run


def _masks(radius: int, n_nodes: int) -> list[int]:
    """Masks of the shards' blocks. With e blocks to agree on, of radius + e, the fewest
    e for which a shard of evenly spread fingerprints has at most 2^PER_SHARD nodes."""
    e = 1
    while e < 8 and 64 * e / (radius + e) + PER_SHARD < log2(max(n_nodes, 2)):
        e += 1
    e = max(e, 2)
    cuts = [round(64 * k / (radius + e)) for k in range(radius + e + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, e)]
    assert len(masks) == comb(radius + e, e)
    return masks


def links(nodes: DataFrame, *, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes`` (fp) that connect all pairs
    within the radius; every link is such a pair."""
    masks = _masks(radius, nodes.count())
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    choice = F.array(*[F.lit(m).cast("bigint") for m in signed])
    keyed = (nodes.select("fp", F.posexplode(choice).alias("shard", "mask"))
             .select("shard", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    sizes = keyed.groupBy("shard", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(sizes, ["shard", "key"])
    pieces = F.ceil(F.col("n") / F.lit(tree_size)).cast("int")
    dealt = (met.withColumn("pieces", pieces)
             .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
             .select("shard", "key", "piece",
                     (F.pmod(F.xxhash64("fp"), F.col("pieces")) == F.col("piece")).alias("is_node"),
                     "fp"))
    together = (dealt.repartition("shard", "key", "piece")
                .sortWithinPartitions("shard", "key", "piece", F.desc("is_node"), "fp"))
    return together.mapInArrow(_searcher(radius), "a bigint, b bigint").distinct()


def _classes(docs: DataFrame, row: str | None, id_col: str, text_col: str, shingle: int,
             radius: int, tree_size: int) -> tuple[DataFrame, DataFrame]:
    """(r, id, fp) of each row, and (fp, first) with the first row of fp's component."""
    rows = (plain(docs, row, id_col, text_col) if row else
            docs.select(F.lit(0).cast("bigint").alias("r"), F.col(f"`{id_col}`").alias("id"),
                        text_or_empty(text_col).alias("text")))
    kind = rows.schema["id"].dataType.simpleString()
    prints = stored(rows.mapInArrow(_fingerprinter(shingle), f"r bigint, id {kind}, fp bigint"),
                    "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min(first_of()).alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius=radius, tree_size=tree_size))
    rooted = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return prints, rooted.select("fp", "root").join(firsts, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints, firsts = _classes(docs, None, id_col, text_col, shingle, radius, tree_size)
    return prints.join(firsts, "fp").select(F.col("id").alias("doc_id"), hex16("fp").alias("fingerprint"),
                                            F.col("first.id").alias("component_id"))


def hex16(col: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS,
             tree_size: int = TREE_SIZE) -> DataFrame:
    """The first row (smallest doc_id) of each component, all columns."""
    rows, row = numbered(docs, "simhash-rows")
    _, firsts = _classes(rows, row, id_col, text_col, shingle, radius, tree_size)
    kept = firsts.select(F.col("first.r").alias(row)).distinct()
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
