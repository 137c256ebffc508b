"""Bounded collects, temporary views, distinct counts, parts of fits."""

import pytest
from pyspark.sql import functions as F

from workbench.functions.bounded import TooManyRows, collected, only_row, temp_views
from workbench.functions.partitions import MAX_PARTS, ROWS_PER_PART, part_count, spread
from workbench.operators import cluster, profile


def test_collect_on_both_sides_of_the_bound(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("x"))
    assert sorted(r.x for r in collected(df, 10)) == list(range(0, 20, 2))
    assert collected(df.limit(0), 0) == []
    for most in (9, 0):
        with pytest.raises(TooManyRows):
            collected(df, most)


def test_the_bound_is_in_the_plan(spark, monkeypatch):
    plans = []
    df = spark.range(1000)
    kind = type(df)
    run = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: plans.append(
        self._jdf.queryExecution().executedPlan().toString()) or run(self))
    with pytest.raises(TooManyRows):
        collected(df, 5)
    assert len(plans) == 1 and "CollectLimit 6" in plans[0]


def test_only_row(spark):
    assert only_row(spark.range(5).agg(F.sum("id")))[0] == 10
    with pytest.raises(LookupError):
        only_row(spark.range(0))
    with pytest.raises(TooManyRows):
        only_row(spark.range(2))


def test_no_unbounded_collect_is_left_in_the_library():
    import pathlib
    import re
    root = pathlib.Path(cluster.__file__).parents[1]
    left = [f"{p.name}: {line.strip()}" for p in root.rglob("*.py") if "llm" not in p.parts
            for line in p.read_text().splitlines()
            if re.search(r"(?<!F)\.(collect|first|toPandas|toLocalIterator|take|head)\(", line)]
    assert left == ["bounded.py: rows = df.limit(most + 1).collect()"]


def test_views_last_as_long_as_the_block(spark):
    before = {t.name for t in spark.catalog.listTables()}
    spark.range(3).createOrReplaceTempView("mine")
    with temp_views(spark, mine=spark.range(7), other=spark.range(2)) as views:
        inside = spark.sql("SELECT count(*) AS n FROM {mine} CROSS JOIN {other}".format(**views))
        assert spark.table("mine").count() == 3  # the caller's view is not hidden
    assert inside.first().n == 14  # usable after the block
    with pytest.raises(ZeroDivisionError):
        with temp_views(spark, mine=spark.range(7)):
            1 / 0
    with pytest.raises(Exception):  # noqa: B017 (what Spark raises for a bad frame)
        with temp_views(spark, good=spark.range(1), bad=None):
            pass
    assert {t.name for t in spark.catalog.listTables()} == before | {"mine"}
    spark.catalog.dropTempView("mine")


def test_distinct_counts(spark):
    nan = float("nan")
    rows = [(1, "a", 0.0, [1], True), (1, None, -0.0, [1], None), (2, "a", nan, None, True), (3, "", nan, [2], None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, a array<int>, b boolean")
    got = {r.field: r.n_values for r in profile.distinct_counts(df).collect()}
    assert got == {"i": 3, "s": 3, "d": 2, "a": 3, "b": 2}
    assert {r.n_values for r in profile.distinct_counts(df.limit(0)).collect()} == {0}
    assert [r.field for r in profile.distinct_counts(df, ["s"]).collect()] == ["s"]


def test_distinct_counts_read_once_and_combine_before_the_exchange(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 3).alias("k")).write.parquet(str(tmp_path / "t"))
    df = profile.distinct_counts(spark.read.parquet(str(tmp_path / "t")))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert plan.count(") Scan parquet") == 1 and ") Expand" not in plan


def test_parts_grow_with_the_rows():
    assert [part_count(n) for n in (0, 1, ROWS_PER_PART, ROWS_PER_PART + 1, 10 * ROWS_PER_PART)] == [1, 1, 1, 2, 10]
    assert part_count(10 ** 13) == MAX_PARTS


def parts_of(df):
    return [[tuple(r) for r in p] for p in df.rdd.glom().collect()]


@pytest.mark.parametrize("equal_rows", [10_000, 50, 7])
def test_parts_do_not_depend_on_the_layout(spark, equal_rows):
    """A few values with many copies, one with half of the rows, and many single rows."""
    rows = [(k % 3, 1.5) for k in range(200)] + [(9, 0.0)] * 500 + [(k, k / 7) for k in range(300)]
    base = spark.createDataFrame(rows, "a int, b double")
    results = [parts_of(spread(base.repartition(n), 4, equal_rows=equal_rows)) for n in (1, 2, 8)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 4
    assert sorted(r for p in results[0] for r in p) == sorted(rows)
    if equal_rows == 7:
        assert max(map(len, results[0])) < 400  # 500 equal rows are dealt out


def test_same_model_for_any_layout_with_equal_rows(spark):
    rows = [(float(k % 5), float(k % 2)) for k in range(600)] + [(7.0, 7.0)] * 400
    df = spark.createDataFrame(rows, "x double, y double")
    models = [cluster.fit_clusters(df.repartition(n), 4, numeric=["x", "y"], seed=1, partitions=3).stages[-1]
              for n in (1, 2, 8)]
    centers = [[c.tolist() for c in m.clusterCenters()] for m in models]
    assert centers[0] == centers[1] == centers[2]


def test_nothing_stays_cached_after_fits(spark):
    df = spark.createDataFrame([(float(k % 9), float(k % 4), "ab"[k % 2]) for k in range(200)],
                               "x double, y double, label string")
    spark.catalog.clearCache()
    cluster.kmeans_sweep(df, [2, 3], numeric=["x", "y"], seed=1).count()
    cluster.entropy_sweep(df, [2, 3], numeric=["x", "y"], seed=1).count()
    cluster.fit_clusters(df, 2, numeric=["x", "y"], seed=1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
