"""Exact top-k by inner product with the threshold algorithm over sorted lists.

Vectors are turned into integers and dealt into shards of about ``shard`` rows by their row
number, whatever their ids are. A shard is built once: its vectors, and for each dimension
the list of its rows in order of that component. Queries are gathered into blocks, and each
block meets each shard by a join on (shard, block): a stated query set against all rows, in
blocks, each of bounded size.

In a shard a query reads all lists side by side from their better ends (the greatest
components where its own is positive, the least where it is negative). Every row that comes
up for the first time is scored in full. A row that has not come up by some depth can score no
more than the sum of the query's components times the values that the lists have there; as
soon as that bound is below the k-th best score, the query stops. Only the best k of each
shard go on, and the best k of those are the result.

Defined results: vectors that are null, or hold a null or non-finite component, take no part;
a vector shorter than another counts as zero beyond its end; every row counts for itself, so
another row with the query's id is a candidate; equal scores go by ascending id, null ids
last; an empty table, or one without queries, gives an empty result. Columns are taken by
name and others ignored. Components and scores must fit 64-bit integers.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workbench.llm.common import stored

TOP, SCALE = 5, 256
SHARD, BLOCK = 4_096, 512
# First depth to which lists are read, and its growth from one look at the bound to the next.
DEPTH, DEEPER = 8, 4
LAST = np.iinfo(np.int64).max


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """One row for each vector, with zeros beyond a vector's end."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    ends = whole.offsets.to_numpy() - whole.offsets[0].as_py()
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes),
        np.arange(len(flat)) - np.repeat(ends[:-1], sizes)] = flat
    return out


def _row(**columns) -> pa.Table:
    return pa.table({c: v if isinstance(v, pa.Array) else pa.array([v], pa.int32()) for c, v in columns.items()})


def _listed(values: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    """One row that holds all values."""
    flat = pa.array(values.reshape(-1), mask=mask)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _build(key: str, with_lists: bool):
    """applyInArrow function: rows (key, row, id, x) of a group as one row, ordered by id, with
    the rows of each dimension in ascending order of their component."""
    def build(table: pa.Table) -> pa.Table:
        ids = table["id"].combine_chunks()
        none = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(LAST).to_numpy()
        rows = table["row"].to_numpy()
        order = np.lexsort((rows, ids, none))
        x = _matrix(table["x"])[order]
        columns = {key: table[key][0].as_py(), "size": len(order), "ids": _listed(ids[order], none[order]),
                   "rows": _listed(rows[order]), "x": _listed(x)}
        if with_lists:
            columns["lists"] = _listed(np.argsort(x, axis=0, kind="stable").T.astype(np.int32))
        return _row(**columns)
    return build


def best_in_shard(x: np.ndarray, lists: np.ndarray, q: np.ndarray, k: int,
                  own: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the ``k`` rows of ``x`` with the greatest inner product with ``q``
    (fewer, if there are fewer), first of equals first, and the depth that was read.
    ``lists``: for each dimension the places of x by ascending component. ``own``: a place
    that is no candidate."""
    n = len(x)
    dims = np.flatnonzero(q)
    up = q[dims] > 0
    fresh = np.ones(n, bool)  # not scored yet
    if own is not None:
        fresh[own] = False
    if not len(dims):
        places = np.flatnonzero(fresh)[:k]
        return places, np.zeros(len(places), x.dtype), 0
    weights = q[dims]
    places, scores = np.zeros(0, np.int64), np.zeros(0, x.dtype)
    rising, falling = dims[~up], dims[up]
    depth, done = DEPTH, 0
    while True:
        to = min(depth, n)
        come = np.zeros(n, bool)
        come[lists[rising, done:to]] = True
        come[lists[falling, n - to:n - done]] = True
        new = np.flatnonzero(come & fresh)
        fresh[new] = False
        places, scores = np.concatenate((places, new)), np.concatenate((scores, x[new] @ q))
        if len(scores) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            good = scores >= kth
            places, scores = places[good], scores[good]
            order = np.lexsort((places, -scores))[:k]
            places, scores = places[order], scores[order]
        if to == n or not fresh.any():
            break
        at = lists[dims, np.where(up, n - to, to - 1)]
        if len(scores) == k and scores[-1] > (x[at, dims] * weights).sum():
            break
        done, depth = to, depth * DEEPER
    order = np.lexsort((places, -scores))
    return places[order], scores[order], to


def _meet(k: int):
    """cogroup function: one shard and one block of queries."""
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            n, m = left["size"][0].as_py(), right["size"][0].as_py()
            flat = lambda t, c: pa.concat_arrays(t[c].chunks).flatten()
            ids = flat(left, "ids").to_pylist()
            rows, query_rows = flat(left, "rows").to_numpy(), flat(right, "rows").to_numpy()
            x = flat(left, "x").to_numpy().reshape(n, -1)
            lists = flat(left, "lists").to_numpy().reshape(-1, n)
            queries = flat(right, "x").to_numpy().reshape(m, -1)
            wide = np.zeros((m, x.shape[1]))
            both = min(wide.shape[1], queries.shape[1])
            wide[:, :both] = queries[:, :both]
            # doubles are exact up to 2^53, and no sum of products is greater than this
            if np.abs(x).max(initial=0) * np.abs(wide).sum(axis=1).max(initial=0) >= 2.0 ** 53:
                x, wide = x.astype(np.int64), wide.astype(np.int64)
            place = {r: i for i, r in enumerate(rows.tolist())}
            for row, name, q in zip(query_rows.tolist(), flat(right, "ids").to_pylist(), wide):
                places, scores, _ = best_in_shard(x, lists, q, k, place.get(row))
                found += [(row, name, ids[p], s) for p, s in zip(places.tolist(), scores.astype(np.int64).tolist())]
        columns = zip(*found) if found else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["row", "query_id", "vec_id", "score"])
    return meet


def top_k(vectors: DataFrame, is_query: Column, *, k: int = TOP, scale: int = SCALE,
          id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD,
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``is_query`` holds (an expression
    of the columns ``id`` and ``row``), the ``k`` other rows with the greatest inner product of
    the vectors floor(scale * component), equal scores by ascending id. Ids are long."""
    whole = F.transform(F.col(f"`{vec_col}`"), lambda v: v.cast("double"))
    usable = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = stored(
        vectors.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                       whole.alias("x"))
        .filter(F.col("x").isNotNull() & usable)
        .withColumn("x", F.transform("x", lambda v: F.floor(v * scale).cast("double"))), "topk-rows")
    asked = rows.filter(is_query)
    shards, blocks = max(1, -(-rows.count() // shard)), max(1, -(-asked.count() // block))

    packed = ("size int, ids array<bigint>, rows array<bigint>, x array<double>")
    index = stored(rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
                   .groupBy("shard").applyInArrow(_build("shard", True), f"shard int, {packed}, lists array<int>"),
                   "topk-shards")
    queries = stored(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
                     .groupBy("block").applyInArrow(_build("block", False), f"block int, {packed}"),
                     "topk-queries")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    met = (index.withColumn("block", each(blocks)).groupBy("shard", "block")
           .cogroup(queries.withColumn("shard", each(shards)).groupBy("shard", "block"))
           .applyInArrow(_meet(k), "row bigint, query_id bigint, vec_id bigint, score bigint"))
    by = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (met.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
