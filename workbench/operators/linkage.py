"""Record-pair scoring and threshold contingency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def additive_score(df: DataFrame, cols: Sequence[str], out: str = "score",
                   default: float = 0.0, keep: Sequence[str] | None = None) -> DataFrame:
    """Row-wise sum of compare columns, a missing value counting as ``default``.

    One projection inside whole-stage codegen (no typed closure, so Catalyst still
    prunes and pushes down). ``keep`` chooses the columns carried next to the score
    (default: all)."""
    score = None
    for c in cols:
        term = F.coalesce(F.col(c).cast("double"), F.lit(float(default)))
        score = term if score is None else score + term
    kept = list(keep) if keep is not None else df.columns
    return df.select(*kept, score.alias(out))


def threshold_crosstab(df: DataFrame, score: str, label: str, t: float,
                       values: Sequence[str] = ("true", "false")) -> DataFrame:
    """Contingency table of ``score >= t`` against the label.

    One row per side of the threshold, one count column per label value; a missing
    cell is null (not 0). The pivot value list is given, so there is no distinct job."""
    return (df.select((F.col(score) >= F.lit(float(t))).alias("above"), label)
            .groupBy("above").pivot(label, list(values)).count())
