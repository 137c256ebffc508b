"""Analysis views over the driver's tables (TPC-H-like parquet files).

Each view stands for one input of the original analyses and is a plain projection or
join, so Catalyst prunes columns and pushes filters into the parquet scan. The same
definitions are written in SQL in ``plans.oracle`` for the independent check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.functions.hashing import md5_u32

# The labelled table has 10 numeric columns, one-hot groups of 4 and of 40,
# and the label: 55 columns with generated names.
NUMERIC_LABELLED = ["q", "e", "d", "t", "u", "line", "month", "day", "part", "order"]
AREAS, KINDS = 4, 40
AREA_COLS = [f"Area_{i}" for i in range(AREAS)]
KIND_COLS = [f"Kind_{i}" for i in range(KINDS)]
LABELLED_COLS = NUMERIC_LABELLED + AREA_COLS + KIND_COLS + ["y"]
# The tenths of rows whose label is drawn at random.
NOISE_TENTHS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pos_zero(c: Column) -> Column:
    # -0.0 and 0.0 print differently; adding +0.0 folds the sign away in both engines
    return c + F.lit(0.0)


def linkage_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair-comparison table: two ids, four compare scores (one with nulls), a match flag."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id_1"),
        F.col("l_partkey").alias("id_2"),
        _pos_zero(F.col("l_discount") * 10).alias("cmp_a"),
        _pos_zero(F.col("l_tax") * 10).alias("cmp_b"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("int"))
        .otherwise(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("cmp_c"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("cmp_d"),
        (F.col("l_returnflag") == "R").alias("is_match"),
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, artist, count) play counts: customers 'playing' parts by quantity."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("artist"),
        F.col("l_quantity").cast("int").alias("count"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name) item catalogue."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("id"), F.col("p_name").alias("name"))


# Length of the made-up factors; every so many ids have none.
FACTORS, NO_USER, NO_ITEM = 8, 40, 50


def fixed_factors(ids: DataFrame, salt: int, without: int) -> DataFrame:
    """(id, features): factors by rule instead of a fit, so that SQL has them too. They are
    multiples of 1/1024 of unlike norm, so sums of products are exact in any order; every
    ``without``-th id has none (as in a model that never saw it)."""
    k = F.col("id").cast("bigint")
    parts = F.transform(F.sequence(F.lit(0), F.lit(FACTORS - 1)), lambda f: (
        ((k * (2 * f + 3) * 31 + f * f * 17 + salt) % 257 - 128) * (1 + k % 7)).cast("double") / 1024.0)
    return ids.where(k % without != 3).select("id", parts.alias("features"))


def alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(artist, alias): every key ending in 9 is a misspelt copy of the key 9 below it."""
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_partkey") % 10 == 9).select(
        F.col("p_partkey").cast("int").alias("artist"),
        (F.col("p_partkey") - 9).cast("int").alias("alias"))


def _labelled_exprs() -> list[Column]:
    q, area, kind = F.col("l_quantity"), F.col("l_suppkey") % AREAS, F.col("l_partkey") % KINDS
    numeric = [q, F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"),
               F.floor(F.col("l_extendedprice") / q), F.col("l_linenumber"),
               F.month("l_shipdate"), F.dayofmonth("l_shipdate"), F.col("l_partkey") % 1000,
               F.col("l_orderkey") % 100]
    exprs = [c.cast("double").alias(n) for c, n in zip(numeric, NUMERIC_LABELLED)]
    exprs += [(area == i).cast("int").alias(n) for i, n in enumerate(AREA_COLS)]
    exprs += [(kind == i).cast("int").alias(n) for i, n in enumerate(KIND_COLS)]
    rule = F.least(F.lit(6), F.floor(q / 8)) + area + F.when(kind >= KINDS // 2, 1).otherwise(0)
    key = ("l_orderkey", "l_linenumber")
    noisy = F.pmod(md5_u32(F.lit(5), *key), F.lit(10)) < NOISE_TENTHS
    label = F.when(noisy, F.pmod(md5_u32(F.lit(6), *key), F.lit(7))).otherwise(F.pmod(rule, F.lit(7)))
    return [*exprs, (1 + label).cast("double").alias("y")]


def labelled(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Multiclass table: 10 numeric features, one-hot groups of 4 and 40, label y in 1..7: a
    rule of three features, but drawn at random for a fifth of the rows.
    ``keyed`` keeps the row key (l_orderkey, l_linenumber) in front."""
    li = table(spark, sf_dir, "lineitem")
    keys = [F.col("l_orderkey"), F.col("l_linenumber")] if keyed else []
    return li.select(*keys, *_labelled_exprs())


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, embedding array<float>, label) points for clustering and projection."""
    return table(spark, sf_dir, "embeddings")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed numeric + categorical rows with a string label (connection-log stand-in)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("label"),
    )


def inflections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(form, lemma): three forms of every word of the documents with four letters or more, made
    by rules that look at its last letters."""
    words = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", r"[^\p{L}]+")).alias("w")).where(F.length("w") >= 4).select(
        F.lower("w").alias("w")).distinct()
    w = F.col("w")
    short = F.substring(w, F.lit(1), F.length(w) - 1)
    def ends(*marks):
        return reduce(lambda a, b: a | b, [w.endswith(m) for m in marks])
    plural = F.when(ends("s", "x", "z", "sh", "ch"), F.concat(w, F.lit("es"))).when(
        ends("y"), F.concat(short, F.lit("ies"))).otherwise(F.concat(w, F.lit("s")))
    past = F.when(ends("e"), F.concat(w, F.lit("d"))).when(
        ends("y"), F.concat(short, F.lit("ied"))).otherwise(F.concat(w, F.lit("ed")))
    going = F.concat(F.when(ends("e"), short).otherwise(w), F.lit("ing"))
    return words.select(F.explode(F.array(plural, past, going)).alias("form"), w.alias("lemma")).distinct()


def nested_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, markup): the letters of the documents in wiki markup, with constructs of every
    kind in one another; one document in seven ends in a template that is never closed."""
    words = F.split(F.trim(F.regexp_replace("text", r"[^\p{L}]+", " ")), " ")
    n = F.size(words)
    def part(a, b):
        return F.array_join(F.slice(words, a, b), " ")
    third = F.floor(n / 3).cast("int")
    marks = F.concat(
        F.lit("{{box|a={{deep|x=[[y|z]]}}|b=<!-- }} -->}}"), part(F.lit(1), third),
        F.lit(" <ref name=q>{{cite|[[u|v]]}}</ref>[[File:f.png|thumb|a [[link|to]] {{b}}]]\n{| class\n| {{c}} {| in |} |}\n[[Page {{d}}|"),
        part(third + 1, third), F.lit("]] '''"), part(2 * third + 1, n), F.lit("'''"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("{{")).otherwise(F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", marks.alias("markup"))


SESSION_NUMERIC = ["quantity", "price", "discount", "tax"]
SESSION_CATEGORICAL = ["returnflag", "linestatus", "priority"]
