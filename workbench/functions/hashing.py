"""Deterministic pseudo-random numbers from md5, identical in Spark SQL and in any SQL
engine with ``md5``: used for splits and sampling that must be reproducible (and
re-computable after an executor loss) without a per-partition random generator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_u32(*parts: Column | str) -> Column:
    """First 32 bits of md5(p1 ':' p2 ':' ...) as a non-negative bigint. A null part is the
    empty string, so (null, 'a') and ('a', null) differ."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    joined = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def hash_bucket(cols: Sequence[Column | str], buckets: int, seed: int = 0) -> Column:
    """Bucket 0..buckets-1 of a row key."""
    return F.pmod(md5_u32(F.lit(seed), *cols), F.lit(buckets))


def hash_split_flag(cols: Sequence[Column | str], train_tenths: int = 9, seed: int = 0) -> Column:
    """True for the training side of a deterministic train/held-out split by key."""
    return hash_bucket(cols, 10, seed) < train_tenths
