"""Plan-shape regression tests: the scale properties the queries were tuned for."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, key):
    df = E.queries()[key](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def scans(p):
    return len(re.findall(r"^\(\d+\) Scan parquet", p, flags=re.M))


def test_field_ranking_is_one_scan_without_key_shuffle(spark):
    p = plan(spark, "feature_delta_ranking")
    assert scans(p) == 1
    assert "hashpartitioning" not in p
    # only the columns the ranking needs are read (ids excluded, no dates)
    assert "l_shipdate" not in p and "l_orderkey" not in p.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("key", ["nearest_center", "pair_score", "undo_one_hot", "random_projection"])
def test_row_wise_queries_do_not_shuffle(spark, key):
    # the centres of nearest_center are a scalar subquery over k rows, planned apart
    assert "Exchange" not in plan(spark, key).split("===== Subqueries =====")[0]


def test_cluster_entropy_scans_once(spark):
    # the centres are a scalar subquery, planned apart
    assert scans(plan(spark, "cluster_entropy").split("===== Subqueries =====")[0]) == 1


def test_vocabulary_is_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "vocabulary")


def test_per_user_windows_are_chunked(spark):
    p = plan(spark, "auc_sampled")
    specs = re.findall(r"windowspecdefinition\(([^)]*)", p)
    assert specs
    for spec in specs:
        if "user#" in spec:
            assert "_chunk" in spec, spec


def test_lookup_broadcast_is_spark_choice(spark):
    assert "BroadcastHashJoin" in plan(spark, "alias_resolve")  # by the estimate of its bytes


@pytest.mark.parametrize("key,n", [("accuracy_f1", 1), ("class_priors", 1), ("prior_accuracy", 2)])
def test_metrics_read_each_side_once(spark, key, n):
    assert scans(plan(spark, key)) == n


def test_sampled_auc_exchanges(spark):
    assert plan(spark, "auc_sampled").count("hashpartitioning(") <= 11
