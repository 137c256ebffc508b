"""Rows for the driver, within a stated bound, and views for SQL text, within a block."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession


class TooManyRows(RuntimeError):
    """More rows than the stated bound; none of them are returned."""


def collected(df: DataFrame, most: int) -> list[Row]:
    """All rows of ``df``, of which there may be at most ``most``. The limit is part of the
    plan: not more than ``most`` + 1 rows reach the driver, and one too many is an error,
    never a silent cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise TooManyRows(f"more than {most} rows for the driver")
    return rows


def only_row(df: DataFrame) -> Row:
    """The row of a table of one row, such as a global aggregate."""
    rows = collected(df, 1)
    if not rows:
        raise LookupError("no row")
    return rows[0]


@contextmanager
def temp_views(spark: SparkSession, **frames: DataFrame) -> Iterator[dict[str, str]]:
    """Temporary views of ``frames`` for as long as the block runs: a dictionary from each name
    to the view's own one, for ``spark.sql(text.format(**views))``. The views have names that
    nobody else uses, so no view of the caller is replaced or hidden, and all are gone after
    the block, also after an error. A DataFrame made in the block stays usable after it."""
    tag = uuid.uuid4().hex
    made: list[str] = []
    try:
        for name, df in frames.items():
            view = f"{name}_{tag}"
            df.createTempView(view)
            made.append(view)
        yield {name: f"{name}_{tag}" for name in frames}
    finally:
        for view in made:
            spark.catalog.dropTempView(view)
