"""Vector arithmetic as SQL higher-order functions on arrays (JVM-side, no UDF).

ML vectors go in and out with ``vector_to_array`` / ``array_to_vector``; results meant
for tables and checks stay plain ``array<double>`` or scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double_array(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def sqdist(a: Column, b: Column) -> Column:
    """Σ (a_i − b_i)²."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def nearest(point: Column, centers: Column) -> Column:
    """struct (dist, cluster) of the nearest of ``centers``, an array of (cluster, center);
    ties go to the lower cluster."""
    return F.array_min(F.transform(centers, lambda c: F.struct(
        sqdist(point, c["center"]).alias("dist"), c["cluster"].alias("cluster"))))


def first_hot_index(cols: Sequence[str]) -> Column:
    """Index of the first column equal to 1 among ``cols``; −1 when none is."""
    return (F.array_position(F.array(*[F.col(c).cast("double") for c in cols]),
                             F.lit(1.0)) - 1).cast("double")
