"""Typed views: check that a DataFrame has the columns and types a record type needs,
then select exactly those columns (the DataFrame form of ``as[T]``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def as_struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def typed_view(df: DataFrame, schema: T.StructType | str, *, strict_nulls: bool = False
               ) -> DataFrame:
    """Select the schema's columns in its order after checking names and types.

    Missing columns or other types raise at once (plan time, no job). With
    ``strict_nulls``, a nullable input column for a non-nullable field also raises."""
    want = as_struct(schema)
    have = {f.name: f for f in df.schema.fields}
    problems = []
    for f in want.fields:
        g = have.get(f.name)
        if g is None:
            problems.append(f"missing column {f.name}")
        elif g.dataType != f.dataType:
            problems.append(f"{f.name}: {g.dataType.simpleString()} is not "
                            f"{f.dataType.simpleString()}")
        elif strict_nulls and g.nullable and not f.nullable:
            problems.append(f"{f.name} may be null")
    if problems:
        raise TypeError("; ".join(problems))
    return df.select(*[f.name for f in want.fields])
