"""A training-data pipeline over the table ``documents``: rejected documents, exact copies,
near copies and contaminated documents go, and what is left is tokenised.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet into the shared folder and reads it back as the next stage's ``docs``. All but
the last return the columns of ``docs``, whatever further columns it has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from workbench.llm import bpe, decontam, exact, quality, simhash
from workbench.llm.common import stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts, the row with the smallest doc_id stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of close fingerprints, the row with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text and the text that they decode to, as digests."""
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_filter), ("exact dedup", exact_dedup),
          ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination),
          ("BPE encoding and decoding", tokens)]

# The classifier's weights have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
