"""Ranked lexical search by a pipeline of term owners.

Documents are cut into blocks; one pass over the texts writes, for every block, the lengths
of its documents and a postings row for each of its terms that some item asks for. Terms are
dealt to owners by the share of the documents that hold them, the rarest first. Items travel
in bundles: a bundle carries, for each block, the sparse accumulators (item, document, score)
of its items through the owners one after the other. At each owner the bundle meets, by
cogroup on (bundle, block), the owner's postings of that block, adds the integer
contributions of the owner's terms and goes on. After the last owner the best documents of
each item are selected.

Contributions are never negative, so an accumulator can be left behind without loss: what the
owners still to come can add to an item at most is known (the sum over its terms there of
weight times the greatest contribution in any document), and between two owners the k-th
highest score so far over all blocks bounds the k-th highest in the end from below. Only
accumulators that cannot reach that bound go; documents that tie with it stay.

No task holds more than one bundle (at most 2^SLOT_BITS items) of one block (at most
``block`` documents); a term that every document has is one postings row in each block. The
filter that keeps other terms from being shuffled has a fixed size; the join after it is exact.

Defined results: null and blank texts have no terms: they rank nowhere and find nothing; every
row of ``docs`` and of ``items`` counts for itself, repeated ids too; equal scores go by
ascending id, null ids last; an empty table on either side gives an empty result. A very long
text is read piece by piece. Columns are taken by name and others ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workbench.llm.common import FILTER_BITS, filter_of, numbered, shipped, stored, text_or_empty
from workbench.session import scratch_path

TOP = 10
# Documents of a block at most, and bytes of its texts after which no document is added.
BLOCK, BLOCK_BYTES = 2_048, 16 << 20
SLOT_BITS = 8
# An owner has the terms that less than 1 / SHARES of the documents hold (and no owner before
# it has); one more owner has the rest.
SHARES = (64, 8, 2)
# Fixed values of the score: weights in thousandths, contributions in billionths, the
# saturation of frequent terms, and the share of the length in per cent.
WEIGHT, UNIT, COUNT, NORM, LENGTH = 1_000, 1_000_000_000, 1_000, 8, 75

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PIECE, REMEMBER, ROWS = 1 << 20, 200_000, 20_000
PEAK = pa.struct([("tf", pa.int32()), ("n", pa.int32())])


def term_counts(data: bytes) -> Counter:
    """Occurrences of each term of a text."""
    counts, at = Counter(), 0
    while at < len(data):
        cut = GAP.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        counts.update(TERM.findall(data[at:end].translate(LOWER)))
        at = end
    return counts


def _peaks(tfs: list[int], ns: list[int]) -> list[dict]:
    """The (tf, n) that no other one beats in both: the greatest contribution is theirs,
    whatever the statistics of the corpus are."""
    out, least = [], None
    for tf, n in sorted(zip(tfs, ns), key=lambda x: (-x[0], x[1])):
        if least is None or n < least:
            out.append({"tf": tf, "n": n})
            least = n
    return out


def _indexer(bits: Broadcast, kind: pa.DataType, block: int):
    """mapInArrow function from (id, text) to postings rows and, with a null term, one row
    of ids and lengths for each block."""
    schema = pa.schema([("block", pa.int64()), ("term", pa.string()),
                        ("docs", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
                        ("peaks", pa.list_(PEAK)), ("ids", pa.list_(kind)), ("ns", pa.list_(pa.int32()))])

    def tables(number: int, post: dict, ids: list, ns: list[int]) -> Iterator[pa.RecordBatch]:
        terms = sorted(post)
        for k in range(0, len(terms), ROWS):
            part = terms[k:k + ROWS]
            docs, tfs = [post[t][0] for t in part], [post[t][1] for t in part]
            none = [None] * len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(part)), pa.array(part, pa.string()),
                 pa.array(docs, schema.field(2).type), pa.array(tfs, schema.field(3).type),
                 pa.array([_peaks(f, [ns[d] for d in at]) for at, f in zip(docs, tfs)], schema.field(4).type),
                 pa.array(none, schema.field(5).type), pa.array(none, schema.field(6).type)], schema=schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip([number, None, None, None, None, ids, ns], schema)],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(shipped(bits), np.uint8)
        known: dict[bytes, bool] = {}

        def asked(term: bytes) -> bool:
            if len(known) > REMEMBER:
                known.clear()
            h = xxhash.xxh64_intdigest(term, 42) & (FILTER_BITS - 1)
            known[term] = out = bool(wanted[h >> 3] >> (7 - (h & 7)) & 1)
            return out

        number = TaskContext.get().partitionId() << 33
        post: dict[bytes, tuple[list, list]] = {}
        ids, ns, size = [], [], 0
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                data = text.as_buffer().to_pybytes()
                counts = term_counts(data)
                at = len(ids)
                for term, tf in counts.items():
                    if known[term] if term in known else asked(term):
                        docs, tfs = post.setdefault(term, ([], []))
                        docs.append(at)
                        tfs.append(tf)
                ids.append(name.as_py())
                ns.append(counts.total())
                size += len(data)
                if len(ids) == block or size > BLOCK_BYTES:
                    yield from tables(number, post, ids, ns)
                    number, post, ids, ns, size = number + 1, {}, [], [], 0
        if ids:
            yield from tables(number, post, ids, ns)
    return run


def _asker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (row, text) to (row, term, times)."""
    for batch in batches:
        for row, text in zip(batch.column(0), batch.column(1)):
            counts = term_counts(text.as_buffer().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.as_py()] * len(counts), pa.int64()), pa.array(list(counts), pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["row", "term", "times"])


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    ends = whole.offsets.to_numpy()
    return whole.flatten().to_numpy(zero_copy_only=False), ends - ends[0]


def _owner_stage(top: int):
    """cogroup function: a bundle of one block and one owner's postings of that block."""
    def advance(left: pa.Table, right: pa.Table) -> pa.Table:
        lengths = _lists(left["m"])[0]
        slots, rest, least = (_lists(left[c])[0] for c in ("slots", "rest", "least"))
        place = np.zeros(1 << SLOT_BITS, np.int64)
        place[slots] = np.arange(len(slots))
        score = np.zeros((len(slots), len(lengths)), np.int64)
        score[place[_lists(left["slot"])[0]], _lists(left["doc"])[0]] = _lists(left["score"])[0]
        docs, doc_ends = _lists(right["docs"])
        tfs = _lists(right["tfs"])[0].astype(np.int64)
        gain_of, gain_ends = _lists(right["gain_slots"])
        gains = _lists(right["gains"])[0]
        impact = UNIT * tfs // (COUNT * tfs + NORM * lengths[docs])
        for k in range(right.num_rows):
            a, b, c, d = doc_ends[k], doc_ends[k + 1], gain_ends[k], gain_ends[k + 1]
            score[np.ix_(place[gain_of[c:d]], docs[a:b])] += gains[c:d, None] * impact[a:b]
        if len(lengths) > top:
            best = np.partition(score, len(lengths) - top, axis=1)[:, -top:]
        else:
            best = score
        if best.shape[1] == top:
            least = np.maximum(least, best[:, 0])
        at, doc = np.nonzero((score > 0) & (score + rest[:, None] >= least[:, None]))
        tops = [sorted(x[x > 0].tolist(), reverse=True) for x in best]
        listed = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.table({
            "bundle": left["bundle"], "block": left["block"], "ids": left["ids"], "m": left["m"],
            "slot": listed(slots[at], pa.int32()), "doc": listed(doc, pa.int32()),
            "score": listed(score[at, doc], pa.int64()),
            "top_slots": listed(np.repeat(slots, [len(x) for x in tops]), pa.int32()),
            "top_scores": listed([s for x in tops for s in x], pa.int64())})
    return advance


def _index(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """Postings rows of the terms asked for, and a row of ids and lengths for each block."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    bits = filter_of(terms.select(F.xxhash64("term").alias("h")))
    arrow = pa.from_numpy_dtype(np.int64) if kind.simpleString() in ("bigint", "int") else pa.string()
    rows = rows.withColumn("id", F.col("id").cast("bigint" if arrow == pa.int64() else "string"))
    id_kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(
        _indexer(bits, arrow, block),
        "block bigint, term string, docs array<int>, tfs array<int>, "
        f"peaks array<struct<tf: int, n: int>>, ids array<{id_kind}>, ns array<int>"), "search-index")


def ranked(docs: DataFrame, items: DataFrame, *, top: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           block: int = BLOCK, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each row of ``items`` with a
    score above 0, highest first. Ids of documents are long, or else strings."""
    items, row = numbered(items, "search-items")
    slot_mask = (1 << SLOT_BITS) - 1
    asked = stored(
        items.select(F.col(f"`{row}`").alias("row"), text_or_empty(item_text).alias("text"))
        .mapInArrow(_asker, "row bigint, term string, times bigint")
        .select(F.shiftright("row", SLOT_BITS).alias("bundle"),
                F.col("row").bitwiseAND(slot_mask).cast("int").alias("slot"), "term", "times"),
        "search-asked")
    index = _index(docs, asked, id_col, text_col, block)
    postings, blocks = index.filter("term is not null"), index.filter("term is null")
    n_docs, n_terms = blocks.select(
        F.sum(F.size(F.filter("ns", lambda n: n > 0))),
        F.sum(F.aggregate("ns", F.lit(0).cast("bigint"), lambda s, n: s + n))).first()
    n_docs, n_terms = n_docs or 0, n_terms or 1

    def norm(n: str) -> str:
        return f"{100 - LENGTH}L + ({LENGTH}L * {n} * {n_docs}L) div {n_terms}L"

    # weight, owner and greatest contribution of each term
    peak = postings.select("term", F.explode("peaks").alias("p")).select(
        "term", "p.tf", F.expr(norm("p.n")).alias("m"))
    highest = peak.groupBy("term").agg(F.max(F.expr(
        f"({UNIT}L * tf) div ({COUNT}L * tf + {NORM}L * m)")).alias("highest"))
    counted = postings.groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    owner = F.lit(len(shares))
    for k, share in reversed(list(enumerate(shares))):
        owner = F.when(F.col("df") * share < n_docs, k).otherwise(owner)
    weight = F.floor(WEIGHT * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    terms = counted.join(highest, "term").select("term", weight.alias("weight"), owner.alias("owner"), "highest")
    routes = stored(asked.join(terms, "term").select(
        "bundle", "slot", "term", "owner", (F.col("times") * F.col("weight")).alias("gain"), "highest"),
        "search-routes")

    # each owner's postings, with the items of a bundle that ask for the term
    routed_path = scratch_path(docs.sparkSession, "llm-search-routed")
    gains = routes.groupBy("bundle", "term", "owner").agg(F.sort_array(
        F.collect_list(F.struct("slot", "gain"))).alias("g"))
    (postings.select("term", "block", "docs", "tfs").join(gains, "term")
     .select("bundle", "block", "docs", "tfs", F.col("g.slot").alias("gain_slots"),
             F.col("g.gain").alias("gains"), "owner")
     .write.partitionBy("owner").parquet(routed_path))
    kinds = ("bundle bigint, block bigint, docs array<int>, tfs array<int>, gain_slots array<int>, "
             "gains array<bigint>, owner int")
    routed = docs.sparkSession.read.schema(kinds).parquet(routed_path)

    # what the owners after the k-th can add to an item at most
    after = [F.coalesce(F.sum(F.when(F.col("owner") > k, F.col("gain") * F.col("highest"))), F.lit(0))
             for k in range(len(shares) + 1)]
    bounds = stored(routes.groupBy("bundle", "slot").agg(F.array(*after).alias("rest")), "search-bounds")
    met = routed.select("bundle", "block").distinct()
    empty = {"slot": "int", "doc": "int", "score": "bigint"}
    lengths = blocks.select("block", "ids", F.expr(f"transform(ns, n -> {norm('n')})").alias("m"))
    bundles = met.join(lengths, "block").select(
        "bundle", "block", "ids", "m",
        *[F.array().cast(f"array<{kind}>").alias(c) for c, kind in empty.items()])
    id_kind = bundles.schema["ids"].dataType.simpleString()
    schema = (f"bundle bigint, block bigint, ids {id_kind}, m array<bigint>, slot array<int>, "
              "doc array<int>, score array<bigint>, top_slots array<int>, top_scores array<bigint>")
    least = None
    for k in range(len(shares) + 1):
        known = bounds.select("bundle", "slot", F.col("rest")[k].alias("rest"))
        known = (known.withColumn("least", F.lit(0).cast("bigint")) if least is None else
                 known.join(least, ["bundle", "slot"], "left").fillna(0, ["least"]))
        facts = stored(known.groupBy("bundle").agg(F.sort_array(F.collect_list(
            F.struct("slot", "rest", "least"))).alias("f")).select(
            "bundle", F.col("f.slot").alias("slots"), F.col("f.rest").alias("rest"),
            F.col("f.least").alias("least")), "search-facts")
        arriving = bundles.join(facts, "bundle")
        # (columns under names of their own: the first bundles come from the same table)
        owned = routed.filter(F.col("owner") == k).select(
            *[F.col(c).alias(c) for c in ("bundle", "block", "docs", "tfs", "gain_slots", "gains")])
        bundles = stored(arriving.groupBy("bundle", "block").cogroup(owned.groupBy("bundle", "block"))
                         .applyInArrow(_owner_stage(top), schema), f"search-owner{k}")
        scores = bundles.select("bundle", F.explode(F.arrays_zip("top_slots", "top_scores")).alias("t")).select(
            "bundle", F.col("t.top_slots").alias("slot"), F.col("t.top_scores").alias("least"))
        by = Window.partitionBy("bundle", "slot").orderBy(F.desc("least"))
        # (partial limits run in the tasks before the exchange)
        least = (scores.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= top)
                 .groupBy("bundle", "slot").agg(F.min("least").alias("least"), F.count("*").alias("n"))
                 .filter(F.col("n") == top).drop("n"))
        bundles = bundles.drop("top_slots", "top_scores")

    found = bundles.select("bundle", "ids", F.explode(F.arrays_zip("slot", "doc", "score")).alias("x")).select(
        "bundle", "x.slot", F.get("ids", F.col("x.doc")).alias("doc_id"), "x.score")
    by = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    names = items.select(F.shiftright(f"`{row}`", SLOT_BITS).alias("bundle"),
                         F.col(f"`{row}`").bitwiseAND(slot_mask).cast("int").alias("slot"),
                         F.col(f"`{item_col}`").alias("item_id"))
    return best.join(names, ["bundle", "slot"]).select("item_id", "rank", "doc_id", "score")
