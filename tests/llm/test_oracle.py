import duckdb
import pytest

from tests.conftest import SF_SMALL
from workbench.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in sql.description]
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(sql.fetchall())
