"""Registered queries of the subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.llm import (bpe, decontam, exact, lines, lm, passages, pii, quality, runs, search,
                           simhash, tokencount, topk)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_exact_dedup", r"""
    with t as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h
        from documents)
    select doc_id, min(doc_id) over (partition by h) as keep_id,
           count(*) over (partition by h) as group_size,
           doc_id = min(doc_id) over (partition by h) as kept, h as text_sha256
    from t""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_copies(table(spark, sf_dir, "documents"))


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"), inside=True)


@register("op4_bpe_round_trip")
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


@register("op5_decontamination", r"""
    with words as (
        select 0 as kind, doc_id as id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
        union all
        select 1, item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
    windows as (
        select distinct id as item_id, least(len(w), 10) as n,
               unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
                                     lambda i: array_to_string(w[i:i + 9], ' '))) as win
        from words where kind = 1 and len(w) > 0),
    places as (
        select id, unnest(range(1, len(w) + 1)) as i, w from words where kind = 0),
    hits as (
        select p.id, p.i, x.n, x.item_id
        from (select id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
              from places, (select distinct n from windows) where i + n - 1 <= len(w)) p
        join windows x on x.win = p.win and x.n = p.n),
    covered as (
        select id, count(distinct j) as n_hit
        from (select id, unnest(range(i, i + n)) as j from hits) group by id),
    items as (
        select id, count(*) as n_items, string_agg(s, ',' order by s) as ids
        from (select distinct id, cast(item_id as varchar) as s from hits) group by id)
    select d.id as doc_id, cast(len(d.w) as bigint) as n_words,
           coalesce(c.n_hit, 0) as n_hit, coalesce(t.n_items, 0) as n_items,
           sha256(coalesce(t.ids, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
    from words d left join covered c using (id) left join items t using (id)
    where d.kind = 0""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"))
    listed = F.encode(F.array_join(F.array_sort("items"), ","), "utf-8")
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(listed, 256).alias("items_sha256"), "contaminated")


@register("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


@register("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.fuzzy_lines(table(spark, sf_dir, "documents"))


@register("op8_simhash_dedup")
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op9_lm_scores")
def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fold_scores(table(spark, sf_dir, "documents"))


@register("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS],
                        F.sha2(F.encode("base", "utf-8"), 256).alias("base_sha256"), "spans")


@register("op11_word_runs")
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted(table(spark, sf_dir, "documents")))
    best = runs.strongest(F.col("runs"))
    listed = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    digest = lambda text: F.sha2(F.encode(text, "utf-8"), 256)
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        digest(F.array_join(listed, "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256")))


@register("op12_ranked_search", r"""
    with d as (
        select row_number() over () as r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
    q as (
        select row_number() over () as i, item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from benchmark),
    size as (
        select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from d where len(w) > 0),
    m as (
        select r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms as m from d, size where len(w) > 0),
    tf as (
        select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by r, term),
    asked as (
        select i, term, count(*) as times from (select i, unnest(w) as term from q) group by i, term),
    weight as (
        select term, cast(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) as bigint) as weight
        from tf, size group by term),
    score as (
        select i, r, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
        from asked join weight using (term) join tf using (term) join m using (r) group by i, r),
    best as (
        select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank
        from score join m using (r) where score > 0)
    select item_id, cast(rank as integer) as rank, doc_id, score from best join q using (i) where rank <= 10""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_top_k", r"""
    with v as (
        select row_number() over () as r, vec_id,
               list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
        from embeddings
        where embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
    score as (
        select q.r, q.vec_id as query_id, c.vec_id,
               cast(list_inner_product(q.x, c.x) as bigint) as score
        from v q join v c on c.r != q.r where q.vec_id % 50 = 0),
    best as (
        select query_id, vec_id, score,
               row_number() over (partition by r order by score desc, vec_id) as rank from score)
    select query_id, cast(rank as integer) as rank, vec_id, score from best where rank <= 5""")
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
