"""Join helpers. Which side is broadcast is left to Spark, which knows the sides' bytes: by
the estimate when it plans, by the measured size when it runs (AQE)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_or_self(df: DataFrame, key: str, mapping: DataFrame, src: str, dst: str) -> DataFrame:
    """Replace ``df[key]`` by ``mapping[dst]`` where ``mapping[src]`` matches, else keep
    it (a map lookup with the key itself as default). One hop only."""
    m = mapping.select(F.col(src).alias("_src"), F.col(dst).alias("_dst"))
    cols = [F.coalesce(F.col("_dst"), F.col(key)).alias(key) if c == key else F.col(c)
            for c in df.columns]
    return df.join(m, df[key] == m["_src"], "left").select(*cols)
