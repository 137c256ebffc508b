"""File readers and writers: delimited text with or without header, plain text lines,
record-delimited XML, and one-word-per-line lists.

All reads are DataFrame sources (split across tasks by file block); nothing is read on
the driver. Declared schemas are preferred: inference costs a full extra pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, *, header: bool = True, null_value: str | None = None,
             schema: T.StructType | str | None = None, infer: bool | None = None,
             names: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Delimited text. ``schema`` fixes the types (no inference pass); otherwise
    ``infer`` (default on) reads all of the data once more. ``names`` renames columns by position,
    for headerless files."""
    r = spark.read.option("header", str(header).lower()).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    elif infer is None or infer:
        r = r.option("inferSchema", "true")
    df = r.csv(path)
    if names is not None:
        if len(names) != len(df.columns):
            raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
        df = df.toDF(*names)
    return df


def write_csv(df: DataFrame, path: str, *, header: bool = True, null_value: str | None = None,
              mode: str = "overwrite") -> str:
    w = df.write.mode(mode).option("header", str(header).lower())
    if null_value is not None:
        w = w.option("nullValue", null_value)
    w.csv(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def write_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> str:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
    return path


def read_xml_records(spark: SparkSession, path: str, row_tag: str,
                     schema: T.StructType | str | None = None) -> DataFrame:
    """One row per ``<row_tag>…</row_tag>`` record (Spark's built-in XML source,
    splittable by record). Give a schema to skip the inference pass."""
    r = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_xml_records(df: DataFrame, path: str, row_tag: str, root_tag: str = "root",
                      mode: str = "overwrite") -> str:
    (df.write.mode(mode).format("xml").option("rowTag", row_tag)
     .option("rootTag", root_tag).save(path))
    return path


def read_word_set(spark: SparkSession, path: str) -> DataFrame:
    """A word list (one word per line) as a distinct one-column table ``word``.
    Used as the small side of semi/anti joins instead of a driver-side set."""
    return (spark.read.text(path).select(F.trim(F.col("value")).alias("word"))
            .where(F.length("word") > 0).distinct())
