"""Profiling: value counts, summary statistics, transposed summaries, grouped
comparisons, range checks and constant-column detection.

All of these are one aggregation pass; the results are tiny (one row per field or per
group), so everything after the first aggregate runs on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workbench.functions.bounded import collected

# The metric names of a summary table, in their printed order.
SUMMARY_METRICS = ("count", "mean", "stddev", "min", "max")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric column names in schema order (booleans and strings left out)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per distinct value, most frequent first (partial aggregation map-side)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.col(count_col).desc(), F.col(col).asc_nulls_last()))


def value_counts_sql(df: DataFrame, col: str) -> DataFrame:
    """Same as ``value_counts`` written as SQL text; the frame is a parameter of the
    statement, so no view is left behind."""
    return df.sparkSession.sql(
        f"SELECT `{col}`, COUNT(*) AS cnt FROM {{rows}} GROUP BY `{col}` ORDER BY cnt DESC", rows=df)


def summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count/mean/stddev/min/max for the given (default: numeric and string) columns.
    Spark's ``describe``: string-typed result, booleans skipped."""
    return df.describe(*cols) if cols else df.describe()


def summary_as_double(desc: DataFrame) -> DataFrame:
    """A summary table with its metric cells read as doubles (lenient: text → null)."""
    fields = [c for c in desc.columns if c != "summary"]
    return desc.select("summary", *[F.expr(f"try_cast(`{c}` AS double)").alias(c)
                                    for c in fields])


def transpose_summary(desc: DataFrame, metrics: Sequence[str] = SUMMARY_METRICS) -> DataFrame:
    """metric × field summary → one row per field with one double column per metric.

    ``unpivot`` + ``pivot`` with an explicit value list (no extra distinct job, fixed
    schema). Cells that are not numbers (a string column's mean) become null."""
    fields = [c for c in desc.columns if c != "summary"]
    long = desc.unpivot("summary", fields, "field", "value").select(
        F.col("summary").alias("metric"), "field",
        F.expr("try_cast(value AS double)").alias("value"))
    return long.groupBy("field").pivot("metric", list(metrics)).agg(F.first("value"))


def grouped_summary(df: DataFrame, by: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Summary statistics of every column for every value of ``by`` in ONE pass.

    Equivalent to filtering each group and transposing its ``describe`` (as the
    original does, one job per group), but a single hash aggregate with map-side
    partial aggregation. Result: (by, field, count, mean, stddev, min, max)."""
    cols = list(cols) if cols else numeric_columns(df, exclude=[by])
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs.append(F.struct(
            F.count(x).cast("double").alias("count"),
            F.avg(x).cast("double").alias("mean"),
            F.stddev_samp(x).cast("double").alias("stddev"),
            F.min(x).cast("double").alias("min"),
            F.max(x).cast("double").alias("max"),
        ).alias(c))
    wide = df.groupBy(by).agg(*aggs)
    return (wide.unpivot(by, cols, "field", "s")
            .select(by, "field", *[F.col(f"s.{m}").alias(m) for m in SUMMARY_METRICS]))


def compare_groups(df: DataFrame, label: str, exclude: Sequence[str] = (),
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Rank fields by how much their mean differs between label = true and false.

    (field, total, delta) where total = count(true)+count(false) of the field's
    non-null values, delta = mean(true) − mean(false), ordered by delta desc, total
    desc. Rows whose label is null belong to neither side.

    One global aggregate with conditional counts and means per field: a single scan
    whose partial buffers are merged in one small final step, with no shuffle by key
    (filtering each side and describing it would scan twice, and a self-join of a
    grouped summary lets the optimizer push each side's filter into its own scan)."""
    cols = [c for c in (cols or numeric_columns(df, exclude=[label])) if c not in exclude]
    yes, no = F.col(label) == F.lit(True), F.col(label) == F.lit(False)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs.append(F.struct(
            F.count(F.when(yes, x)).cast("double").alias("count_t"),
            F.avg(F.when(yes, x)).cast("double").alias("mean_t"),
            F.count(F.when(no, x)).cast("double").alias("count_f"),
            F.avg(F.when(no, x)).cast("double").alias("mean_f"),
        ).alias(c))
    long = df.agg(*aggs).unpivot([], cols, "field", "s")
    return (long.select("field",
                        (F.col("s.count_t") + F.col("s.count_f")).alias("total"),
                        (F.col("s.mean_t") - F.col("s.mean_f")).alias("delta"))
            .orderBy(F.col("delta").desc(), F.col("total").desc()))


def compare_summaries(yes: DataFrame, no: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """The same ranking from the transposed summaries of the two sides, which hold one row
    per field."""
    left = yes.select("field", F.col("count").alias("n_yes"), F.col("mean").alias("mean_yes"))
    right = no.select("field", F.col("count").alias("n_no"), F.col("mean").alias("mean_no"))
    both = left.where(~F.col("field").isin(list(exclude))).join(right, "field")
    return (both.select("field", (F.col("n_yes") + F.col("n_no")).alias("total"),
                        (F.col("mean_yes") - F.col("mean_no")).alias("delta"))
            .orderBy(F.desc("delta"), F.desc("total")))


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min and max of several columns in one aggregate: (min_c, max_c, ...)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(field, n_values, constant) for each column in one aggregate pass.

    A column is constant when it holds at most one distinct value counting null as a
    value: all null, or no null and min = max. Exact, and needs no distinct count.
    ``n_values`` is 1 or 2 (2 meaning "two or more")."""
    cols = list(cols) if cols else df.columns
    total = F.count(F.lit(1))
    structs = []
    for c in cols:
        x = F.col(c)
        nn = F.count(x)
        same = F.min(x) == F.max(x)
        n_values = (F.when(nn == 0, F.lit(1))
                    .when((nn == total) & same, F.lit(1))
                    .otherwise(F.lit(2)))
        structs.append(n_values.alias(c))
    wide = df.agg(*structs)
    return (wide.unpivot([], cols, "field", "n_values")
            .select("field", F.col("n_values").cast("int").alias("n_values"),
                    (F.col("n_values") <= 1).alias("constant")))


def structure(df: DataFrame) -> DataFrame:
    """(position, field, type, rows_with, least, greatest): the schema of a table and, from one
    aggregate over it, how many rows have a value and between which texts they lie."""
    fields = df.schema.fields
    found = df.agg(*[F.struct(F.count(c), F.min(c).cast("string"), F.max(c).cast("string")).alias(f"_{i}")
                     for i, c in enumerate(F.col(f"`{f.name}`") for f in fields)])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("field"),
                     F.lit(f.dataType.simpleString()).alias("type"), F.col(f"_{i}")["col1"].alias("rows_with"),
                     F.col(f"_{i}")["col2"].alias("least"), F.col(f"_{i}")["col3"].alias("greatest"))
            for i, f in enumerate(fields)]
    return found.select(F.inline(F.array(*rows)))


def peek(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the order of the named columns, and of all others after them, so
    that the same rows come each time (a bounded top-k, no sort of the table)."""
    return df.orderBy(*order, *[c for c in df.columns if c not in order]).limit(n)


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(field, n_values): the exact number of distinct values of each column, null counting
    as a value; arrays, structs and maps by their JSON text, 0.0 and -0.0 as one.

    One pass: each row becomes one (field, value) row for each column, equal ones meet in
    an aggregate with map-side combine, and what is left is counted by field. A value that
    a third of the rows hold is one row of each task; no column's values gather anywhere."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]

    def text(f) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(c)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0).cast(f.dataType)
        return F.base64(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")

    cells = df.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("field"), text(f).alias("value"))
                                         for f in fields])))
    values = cells.groupBy("field", "value").agg(F.lit(1).alias("_"))
    # an empty table has no cells: every column is listed with 0
    names = df.sparkSession.createDataFrame([(f.name,) for f in fields], "field string")
    counted = values.groupBy("field").agg(F.count(F.lit(1)).alias("n_values"))
    return names.join(counted, "field", "left").na.fill(0, ["n_values"])


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop the constant columns (the driver receives one flag per column: bounded)."""
    flags = collected(constant_columns(df, cols).where("constant").select("field"), len(df.columns))
    return df.drop(*[r.field for r in flags])
