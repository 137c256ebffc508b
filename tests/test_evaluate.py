"""Per-user AUC (rank form vs brute-force pairs, T9, T10, T12, T13), negative sampling
(T11), running totals, priors and metrics (T17–T19)."""

import itertools
import math
import random

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from workbench.functions.prefix import dense_index, running_total
from workbench.operators import evaluate


def brute_auc(pos, neg):
    """Reference semantics: all pairs per user, NaN never wins (treated as null)."""
    out = {}
    users = {u for u, _ in pos} & {u for u, _ in neg}
    for u in users:
        ps = [p for v, p in pos if v == u]
        ns = [n for v, n in neg if v == u]
        def ok(a, b):
            if a is None or b is None or math.isnan(a) or math.isnan(b):
                return False
            return a > b
        out[u] = sum(ok(a, b) for a, b in itertools.product(ps, ns)) / (len(ps) * len(ns))
    return out


def _auc(spark, pos, neg):
    p = spark.createDataFrame(pos, "user int, prediction double")
    n = spark.createDataFrame(neg, "user int, prediction double")
    return {r.user: r.auc for r in evaluate.per_user_auc(p, n).collect()}


def test_auc_edge_cases(spark):
    pos = [(1, 0.9), (1, 0.5), (1, 0.5), (2, None), (2, 0.3), (3, 1.0), (4, float("nan"))]
    neg = [(1, 0.5), (1, 0.1), (1, None), (2, 0.3), (2, 0.2), (4, 0.0), (5, 0.4)]
    got = _auc(spark, pos, neg)
    want = brute_auc(pos, neg)
    assert set(got) == set(want) == {1, 2, 4}  # user 3 has no negative
    for u in want:
        assert math.isclose(got[u], want[u])


def test_auc_random_against_pairs(spark):
    rnd = random.Random(5)
    pos, neg = [], []
    for u in range(40):
        for _ in range(rnd.randint(0, 6)):
            pos.append((u, rnd.choice([None, float("nan"), round(rnd.random(), 1)])))
        for _ in range(rnd.randint(0, 6)):
            neg.append((u, rnd.choice([None, round(rnd.random(), 1)])))
    got, want = _auc(spark, pos, neg), brute_auc(pos, neg)
    assert set(got) == set(want)
    assert all(math.isclose(got[u], want[u]) for u in want)


def test_perfect_and_constant_predictor(spark):
    pos = [(u, 1.0) for u in range(5)]
    neg = [(u, 0.0) for u in range(5)]
    assert set(_auc(spark, pos, neg).values()) == {1.0}
    assert set(_auc(spark, neg, neg).values()) == {0.0}


def test_running_total_matches_window_with_hot_key(spark):
    rows = [(0, i, i % 3) for i in range(3000)] + [(k, i, 1) for k in range(1, 20)
                                                   for i in range(10)]
    df = spark.createDataFrame(rows, "k int, o int, v int")
    mine = running_total(df, "k", ["o"], "v", "run", partitions=16)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w)).select("k", "o", "ref",
                                                           F.col("v").alias("rv"))
    joined = mine.join(ref, ["k", "o"])
    assert joined.count() == len(rows)
    assert joined.where(F.col("run") != F.col("ref")).count() == 0
    strict = running_total(df, "k", ["o"], "v", "run", inclusive=False, partitions=16)
    assert strict.join(ref, ["k", "o"]).where(
        F.col("run") != F.col("ref") - F.col("rv")).count() == 0


def test_dense_index(spark):
    df = spark.createDataFrame([(v,) for v in [5, 3, 9, 3, 7, 5]], "x int")
    assert sorted(map(tuple, dense_index(df, "x").collect())) == [(3, 0), (5, 1), (7, 2), (9, 3)]


def test_sample_negatives_dense_catalog(spark):
    # user 1 holds all but one of 50 items; user 2 holds two items
    items = spark.createDataFrame([(i,) for i in range(50)], "artist int")
    pos = spark.createDataFrame([(1, i) for i in range(49)] + [(2, 3), (2, 4), (2, 4)],
                                "user int, artist int")
    neg = evaluate.sample_negatives(pos, items, seed=3)
    rows = neg.collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user, []).append(r.artist)
    # user 1: every draw that succeeds is item 49, at most 49 of them, and at least one
    assert set(by_user[1]) == {49} and 1 <= len(by_user[1]) <= 49
    # user 2: exactly as many negatives as distinct positives, none of them positive
    assert len(by_user[2]) == 2 and not set(by_user[2]) & {3, 4}
    # deterministic
    assert sorted(map(tuple, rows)) == sorted(map(tuple, neg.collect()))


def test_priors_join_on_class(spark):
    train = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (3.0,)], "y double")
    test = spark.createDataFrame([(2.0,), (3.0,), (3.0,), (4.0,)], "y double")
    p = {r.y: r.p for r in evaluate.class_priors(train, "y").collect()}
    assert p == {1.0: 0.5, 2.0: 0.25, 3.0: 0.25}
    acc = evaluate.prior_accuracy(train, test, "y").first().accuracy
    assert math.isclose(acc, 0.25 * 0.25 + 0.25 * 0.5)


def test_confusion_keeps_predicted_only_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 3.0)],
                               "y double, prediction double")
    cm = {r.y: (r["1"], r["2"], r["3"]) for r in
          evaluate.confusion_matrix(df, "y", "prediction", [1, 2, 3]).collect()}
    assert cm == {1.0: (1, 1, 0), 2.0: (0, 1, 1)}


def test_accuracy_f1_equals_evaluator(spark):
    rnd = random.Random(1)
    rows = [(float(rnd.randint(1, 4)), float(rnd.randint(0, 4))) for _ in range(300)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    mine = evaluate.accuracy_f1(df, "y", "prediction").first()
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction")
    assert math.isclose(mine.accuracy, ev.setMetricName("accuracy").evaluate(df))
    assert math.isclose(mine.weighted_f1, ev.setMetricName("f1").evaluate(df))


def test_hash_split_is_stable_and_roughly_ninety(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = evaluate.hash_split(df, ["k"])
    n = train.count()
    assert 4300 < n < 4700 and n + test.count() == 5000
    assert n == evaluate.hash_split(df.repartition(7), ["k"])[0].count()


def test_confusion_row_sums_are_class_counts(spark):
    rnd = random.Random(2)
    rows = [(float(rnd.randint(1, 7)), float(rnd.randint(1, 7))) for _ in range(500)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    cm = evaluate.confusion_matrix(df, "y", "prediction", list(range(1, 8))).collect()
    counts = {r.y: r["count"] for r in evaluate.class_priors(df, "y").collect()}
    for r in cm:
        assert sum(r[str(c)] for c in range(1, 8)) == counts[r.y]


def test_hot_user_is_split_across_chunks_and_auc_exact(spark):
    from workbench.functions import prefix
    rnd = random.Random(9)
    pos = [(0, round(rnd.random(), 3)) for _ in range(600)]
    neg = [(0, round(rnd.random(), 3)) for _ in range(600)]
    for u in range(1, 60):
        pos += [(u, round(rnd.random(), 2)) for _ in range(3)]
        neg += [(u, round(rnd.random(), 2)) for _ in range(3)]
    got, want = _auc(spark, pos, neg), brute_auc(pos, neg)
    assert set(got) == set(want) and all(math.isclose(got[u], want[u]) for u in want)
    # the hot user's rows land in several range chunks, not one task
    df = spark.createDataFrame([(0, i) for i in range(2000)] + [(u, 0) for u in range(1, 50)],
                               "k int, o int")
    chunks = prefix._chunks(df, ["k", "o"], 8)
    assert chunks.where("k = 0").select("_chunk").distinct().count() >= 4


def test_running_total_property(spark):
    """Random keys (one hot), both chunkings, against a per-key cumulative sum."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=120,
                    unique=True))
    def check(pairs):
        rows = [(k, o, (o * 7 + k) % 5) for k, o in pairs]
        df = spark.createDataFrame(rows, "k int, o int, v int")
        acc, want = {}, {}
        for k, o, v in sorted(rows):
            acc[k] = acc.get(k, 0) + v
            want[(k, o)] = acc[k]
        for kw in ({"partitions": 4}, {"chunk": F.floor(F.col("o") / 8)}):
            got = {(r.k, r.o): r.run for r in
                   running_total(df, "k", ["o"], "v", "run", **kw).collect()}
            assert got == want
    check()


def test_all_negatives_auc_against_brute_force(spark):
    rnd = random.Random(4)
    items = list(range(30))
    score = {i: rnd.choice([None, float("nan"), float(rnd.randint(0, 6))]) for i in items}
    pos = [(u, rnd.choice(items)) for u in range(12) for _ in range(rnd.randint(1, 6))]
    pos += [(99, i) for i in items]  # a user who holds everything: no negative
    scores = spark.createDataFrame([(i, score[i]) for i in items], "artist int, prediction double")
    p = spark.createDataFrame(pos, "user int, artist int")
    got = {r.user: r.auc for r in evaluate.per_user_auc_all_negatives(p, scores).collect()}
    want = {}
    for u in {u for u, _ in pos}:
        mine = [i for v, i in pos if v == u]
        negs = [i for i in items if i not in set(mine)]
        if not negs:
            continue
        pairs = [(score[a], score[b]) for a in mine for b in negs]
        ok = sum(1 for a, b in pairs if a is not None and b is not None
                 and not math.isnan(a) and not math.isnan(b) and a > b)
        want[u] = ok / len(pairs)
    assert set(got) == set(want) and 99 not in got
    assert all(math.isclose(got[u], want[u]) for u in want)


def test_mean_auc_many_equals_separate_runs(spark):
    from workbench.operators import recommend
    rnd = random.Random(3)
    plays = spark.createDataFrame([(u, rnd.randint(0, 40), rnd.randint(1, 9))
                                   for u in range(30) for _ in range(8)],
                                  "user int, artist int, count int")
    train, cv = evaluate.hash_split(plays, ["user", "artist"], train_tenths=6)
    neg = evaluate.sample_negatives(cv, plays.select("artist"), seed=1)
    pop = recommend.popularity_predictor(train)
    inv = lambda df: pop(df).withColumn("prediction", -F.col("prediction"))
    many = {r.predictor: r.mean_auc for r in
            evaluate.mean_auc_many(cv, neg, {"pop": pop, "inv": inv}).collect()}
    for name, p in (("pop", pop), ("inv", inv)):
        one = evaluate.mean_auc(cv, neg, p).first().mean_auc
        assert math.isclose(many[name], one)


def test_null_key_parts_are_not_skipped(spark):
    from workbench.functions.hashing import md5_u32
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert len({r[0] for r in df.select(md5_u32("x", "y")).collect()}) == 2
