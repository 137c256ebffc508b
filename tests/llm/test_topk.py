import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from workbench.llm import topk

COLUMNS = "vec_id bigint, embedding array<float>, rank int, row string, score int, x string"


def plain(rows, k=5, every=50):
    """(query_id, rank, vec_id, score) by scoring all pairs."""
    good = [(i, [math.floor(256 * float(np.float32(v))) for v in x]) for i, x in rows
            if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    for n, (i, q) in enumerate(good):
        if i is None or i % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, x)), j is None, j or 0)
                      for m, (j, x) in enumerate(good) if m != n)[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(best)]
    return sorted(out, key=str)


def run(spark, rows, every=50, **options):
    df = spark.createDataFrame([(i, x, None, None, None, None) for i, x in rows], COLUMNS).repartition(3)
    return sorted(map(tuple, topk.top_k(df, F.col("id") % every == 0, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard": 40, "block": 3}, {"shard": 7, "block": 2, "k": 2}])
def test_equals_plain_version(spark, options):
    rng = random.Random(7)
    # vectors of few values: many equal scores; a third are one vector
    one = [rng.uniform(-1, 1) for _ in range(8)]
    rows = [(k, one if rng.random() < 0.33 else [rng.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(8)])
            for k in range(300)]
    assert run(spark, rows, every=10, **options) == plain(rows, options.get("k", 5), 10)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, -1.0, 5.0]), (2, []), (3, None), (4, [1.0, None]),
            (5, [nan, 1.0]), (6, [inf]), (None, [0.5, 0.5]), (50, []), (100, [1e6, 1e6]), (7, [-1e6, 2e6, 3.0])]
    got = run(spark, rows)
    assert got == plain(rows)
    assert {r[0] for r in got} == {0, 50, 100}
    assert run(spark, [(1, [1.0])]) == [] and run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_large_numbers_are_exact(spark):
    rows = [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 20, 1.0]), (2, [2.0 ** 20, 2.0]), (3, [1.0, 2.0 ** 20])]
    assert run(spark, rows) == plain(rows)
    assert plain(rows)[0][3] > 2 ** 53


def test_lists_are_read_only_as_deep_as_the_bound_asks():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.pareto(1.0, (4_096, 4)))  # few rows stand out
    lists = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
    places, scores, depth = topk.best_in_shard(x, lists, np.array([3.0, 1.0, 0.0, 2.0]), 5)
    every = x @ np.array([3.0, 1.0, 0.0, 2.0])
    want = np.lexsort((np.arange(len(x)), -every))[:5]
    assert places.tolist() == want.tolist() and scores.tolist() == every[want].tolist()
    assert depth < len(x) // 8
    # a query against the sign of its component reads the lists from the other end
    places, scores, _ = topk.best_in_shard(-x, np.argsort(-x, axis=0, kind="stable").T.astype(np.int32),
                                           np.array([-3.0, -1.0, 0.0, -2.0]), 5, own=int(want[0]))
    assert want[0] not in places and scores[0] == every[want[1]]
