"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks of fixed length. A chunk's hash is its bytes taken as the
coefficients of a polynomial, at a fixed base modulo a prime. Hashes compose: the hash of
AB is hash(A) * base^|B| + hash(B), so each chunk's hash, shifted by the number of bytes
that follow it, is one term of a plain sum. Terms can therefore be made anywhere, in any
order, and a document of any length is hashed in parallel.

Equal length and fingerprints only nominate copies: each member of a class is then
compared with the first member, chunk by chunk, and rows that differ form classes anew
until every class holds one text.

Defined results: a null text is the empty text (and so a copy of every other empty or
null one); of rows that repeat one doc_id exactly one stays; null doc_ids come after all
others; an empty table gives an empty result; further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workbench.llm.common import SPACE_RUN, first_of, numbered, plain, stored, texts

# Primes below 2^31, so that a byte times a power, summed over a chunk, fits 64 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_071)
CHUNK = 1 << 16
# Longer texts are dealt out chunk by chunk over all tasks.
SPREAD = 1 << 20
KEY = ["n_bytes", "f1", "f2"]


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def _terms(primes: tuple[int, int], chunk: int):
    """mapInArrow function: (r, after, data) to (r, t1, t2), the chunk's two hashes, each
    shifted by the ``after`` bytes that follow the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = []
        for p, base in zip(primes, BASES):
            table, x = np.ones(chunk, np.uint64), 1
            for i in range(chunk):
                table[i] = x
                x = x * base % p
            powers.append(table)
        for batch in batches:
            data, ends = texts(batch.column(2))
            after = batch.column(1).to_pylist()
            out = [np.zeros(len(after), np.int64) for _ in primes]
            for k, more in enumerate(after):
                piece = data[ends[k]:ends[k + 1]][::-1].astype(np.uint64)
                for j, (p, base) in enumerate(zip(primes, BASES)):
                    # a chunk's sum stays below 2^8 * 2^31 * 2^16 = 2^55
                    h = int((piece * powers[j][:len(piece)]).sum()) % p
                    out[j][k] = h * pow(base, more, p) % p
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x) for x in out)], ["r", "t1", "t2"])
    return run


def _chunks(texts_df: DataFrame, chunk: int) -> DataFrame:
    """One row per chunk: (r, part, after, data); an empty text has one empty chunk."""
    data, n = F.encode("text", "utf-8"), F.octet_length("text")
    parts = F.greatest(F.ceil(n / F.lit(chunk)).cast("int"), F.lit(1))
    return (texts_df.withColumn("data", data).withColumn("n", n)
            .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select(*[c for c in texts_df.columns if c != "text"], "part",
                    F.greatest(F.col("n") - (F.col("part") + 1) * chunk, F.lit(0))
                    .cast("bigint").alias("after"),
                    F.expr(f"substring(data, part * {chunk} + 1, {chunk})").alias("data")))


def fingerprints(rows: DataFrame, primes=PRIMES, chunk: int = CHUNK,
                 spread: int = SPREAD) -> DataFrame:
    """(r, f1, f2) of each text of ``rows`` (r, text)."""
    n = F.octet_length("text")
    terms = "r bigint, t1 bigint, t2 bigint"
    cut = ["r", "after", "data"]
    short = _chunks(rows.filter(n <= spread), chunk).select(*cut)
    long = _chunks(rows.filter(n > spread), chunk).repartition("r", "part").select(*cut)
    run = _terms(primes, chunk)
    parts = short.mapInArrow(run, terms).unionAll(long.mapInArrow(run, terms))
    # at most 2^31 per term: the sum of 2^32 chunks still fits
    return parts.groupBy("r").agg(
        F.pmod(F.sum("t1"), F.lit(primes[0])).alias("f1"),
        F.pmod(F.sum("t2"), F.lit(primes[1])).alias("f2"))


def _differing(members: DataFrame, rows: DataFrame, chunk: int) -> DataFrame:
    """Rows of ``members`` (r, first_r) whose text is not that of first_r: every chunk of
    a member is held against the same chunk of its class's first row."""
    heads = members.select(F.col("first_r").alias("r")).distinct()
    wanted = (members.select("r", "first_r")
              .unionByName(heads.withColumn("first_r", F.lit(None).cast("bigint"))))
    pieces = _chunks(rows.join(wanted, "r").select("r", "first_r", "text"), chunk)
    mine = pieces.filter(F.col("first_r").isNotNull()).select("r", "first_r", "part", "data")
    head = (pieces.filter(F.col("first_r").isNull())
            .select(F.col("r").alias("first_r"), "part", F.col("data").alias("head_data")))
    return (mine.join(head, ["first_r", "part"], "left")
            .filter(~F.col("data").eqNullSafe(F.col("head_data"))).select("r").distinct())


def copies(docs: DataFrame, row: str, *, id_col: str = "doc_id", text_col: str = "text",
           primes=PRIMES, chunk: int = CHUNK, spread: int = SPREAD) -> DataFrame:
    """One row per row of the numbered table ``docs``: (r, id, text_sha256, first_r,
    keep_id, group_size). ``first_r`` is the row that stays."""
    rows = plain(docs, row, id_col, text_col).withColumn("text", normalised(F.col("text")))
    facts = rows.select("r", "id", F.octet_length("text").alias("n_bytes"),
                        F.sha2(F.encode("text", "utf-8"), 256).alias("text_sha256"))
    open_rows = stored(facts.join(fingerprints(rows.select("r", "text"), primes, chunk, spread),
                                  "r"), "exact-fingerprints")
    done: list[DataFrame] = []
    while True:
        groups = (open_rows.groupBy(*KEY)
                  .agg(F.min(first_of()).alias("first"), F.count("*").alias("group_size")))
        classed = open_rows.join(
            groups.select(*KEY, F.col("first.r").alias("first_r"),
                          F.col("first.id").alias("keep_id"), "group_size"), KEY)
        members = classed.filter((F.col("group_size") > 1) & (F.col("r") != F.col("first_r")))
        bad = stored(_differing(members, rows.select("r", "text"), chunk), "exact-differing")
        if bad.isEmpty():
            done.append(classed)
            break
        same = classed.join(bad, "r", "left_anti").drop("group_size")
        sizes = same.groupBy("first_r").agg(F.count("*").alias("group_size"))
        done.append(same.join(sizes, "first_r"))
        open_rows = stored(open_rows.join(bad, "r", "left_semi"), "exact-open")
    cols = ["r", "id", "text_sha256", "first_r", "keep_id", "group_size"]
    return reduce(DataFrame.unionAll, [d.select(*cols) for d in done])


def find_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    rows, row = numbered(docs.select(id_col, text_col), "exact-rows")
    found = copies(rows, row, id_col=id_col, text_col=text_col, **options)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                        (F.col("r") == F.col("first_r")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` without later copies of an equal normalised text; all columns."""
    rows, row = numbered(docs, "exact-rows")
    found = copies(rows, row, id_col=id_col, text_col=text_col, **options)
    kept = found.filter(F.col("r") == F.col("first_r")).select(F.col("r").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
