import random

import pytest

from tests.llm.helpers import Groups
from workbench.llm.components import components


@pytest.mark.parametrize("n,m", [(60, 40), (200, 150)])
def test_random_graphs(spark, n, m):
    random.seed(n)
    edges = [(random.randrange(n), random.randrange(n)) for _ in range(m)]
    g = Groups(range(n))
    for a, b in edges:
        g.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: g.root(x) for x in linked}


def test_a_long_path_and_no_edges(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    assert {r.root for r in components(path).collect()} == {0}
    assert components(path.limit(0)).count() == 0
