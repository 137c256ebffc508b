"""Every registered query with SQL, against DuckDB on the small tables; every query
without SQL must at least run."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
FAST_ROWS_ONLY = ["tree_predict", "tree_importance", "pca_scores", "pca_variance",
                  "als_topn_batch", "tfidf_vectors", "kmeans_formula"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, con, key):
    ok, why = compare(E.queries()[key](spark, SF), con.sql(SQL[key]))
    assert ok, why


@pytest.mark.parametrize("key", FAST_ROWS_ONLY)
def test_rows_only_query_runs(spark, key):
    assert E.queries()[key](spark, SF).count() >= 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["field", "total", "delta"] and df.count() == 4
