"""K-means steps over packed matrices, against Spark ML's own."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from workbench.operators import cluster, kmeans_start, lloyd


def points(spark, rows):
    return spark.createDataFrame([(x,) for x in rows], "x array<double>").select(array_to_vector("x").alias("v"))


@pytest.mark.parametrize("max_iter", [0, 1, 4, 50])
def test_fit_equals_spark_ml(spark, max_iter):
    rng = np.random.default_rng(1)
    rows = (rng.normal(size=(600, 3)) * [1, 50, 1000] + [0, 9, 1e5]).tolist()
    df = points(spark, rows + rows[:100]).repartition(3).cache()
    own = lloyd.Lloyd(6, "v", "cluster", max_iter=max_iter, tol=1e-4, seed=5).fit(df)
    ml = KMeans(k=6, featuresCol="v", predictionCol="ml", maxIter=max_iter, tol=1e-4, seed=5).fit(df)
    assert np.allclose(own.clusterCenters(), ml.clusterCenters(), rtol=1e-9)
    assert own.summary.trainingCost == pytest.approx(ml.summary.trainingCost, rel=1e-9)
    assert own.summary.numIter == ml.summary.numIter
    both = ml.transform(own.transform(df))
    assert both.where(F.col("cluster") != F.col("ml")).count() == 0


def test_cluster_without_rows_keeps_its_center(spark):
    matrices = lloyd.packed(points(spark, [[0.0], [1.0]]), "v")
    centers, cost, steps = lloyd.moved(matrices, np.array([[0.0], [0.0], [99.0]]), 1, 1e-4)
    # equal distances go to the lower cluster, so the second one is empty too
    assert centers.tolist() == [[0.5], [0.0], [99.0]] and cost == 1 and steps == 1


def test_fewer_points_than_clusters(spark):
    model = lloyd.Lloyd(4, "v", "cluster", max_iter=3, tol=1e-4, seed=1).fit(points(spark, [[1.0]] * 5 + [[2.0]]))
    assert 1 <= len(model.clusterCenters()) <= 4 and model.summary.trainingCost == 0


def test_large_fits_of_a_sweep_run_one_by_one():
    """The start of a fit keeps vectors of its own: eight at once would not fit in memory."""
    import threading
    import time
    now, most, lock = [0], [0], threading.Lock()

    def run(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1
        return k
    assert cluster._each(range(8), run, None, 36_000_000) == list(range(8)) and most == [1]
    cluster._each(range(8), run, None, 1000)
    assert most[0] > 1


def test_a_step_takes_many_parts_in_few_tasks(spark):
    """Starting a task costs more than a part's work: steps over 60 parts had 60 tasks."""
    assert [lloyd.step_tasks(n) for n in (0, 1, 8, 24, 25, 480, 481, 2880)] == [1, 1, 8, 24, 24, 24, 25, 144]
    rows = np.random.default_rng(3).normal(size=(900, 2)).tolist()
    matrices = lloyd.packed(points(spark, rows).repartition(60), "v")
    one = lloyd.packed(points(spark, rows).coalesce(1), "v")
    tracker, sc, start = spark.sparkContext.statusTracker(), spark.sparkContext, np.array(rows[:5])
    matrices.count()
    sc.setJobGroup("lloyd-step", "one step")
    centers, cost, _ = lloyd.moved(matrices, start, 1, 1e-4)
    sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("lloyd-step") for s in tracker.getJobInfo(j).stageIds]
    most = max(info.numTasks for s in stages if (info := tracker.getStageInfo(s)) is not None)
    assert most <= lloyd.FEW_TASKS
    again, other, _ = lloyd.moved(one, start, 1, 1e-4)
    assert np.allclose(centers, again, rtol=1e-12) and abs(cost - other) < 1e-9 * cost
    matrices.unpersist()
    one.unpersist()


@pytest.mark.parametrize("n, parts, k", [(2, 1, 2), (20, 7, 3), (3000, 5, 40), (9000, 70, 12)])
def test_start_is_that_of_spark_ml(spark, monkeypatch, n, parts, k):
    """The same rows are drawn, in whatever matrices the rows are packed."""
    rng = np.random.default_rng(n)
    rows = np.column_stack([rng.normal(size=n) * 30, rng.integers(0, 3, size=(n, 2)), rng.exponential(size=n)])
    df = points(spark, rows.tolist()).repartition(parts).cache()
    for seed in (5, 77):
        ml = KMeans(k=k, featuresCol="v", maxIter=0, seed=seed).fit(df)
        matrices = lloyd.packed(df, "v")
        again, other = kmeans_start.started(matrices, [k, 2 * k], seed)
        assert np.allclose(again, ml.clusterCenters(), rtol=1e-9) and len(other) <= 2 * k
        matrices.unpersist()


def test_numbers_are_those_of_sparks_generator(spark):
    for seed in (0, -7, 123456789):
        java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        assert kmeans_start.uniforms(seed, 100).tolist() == [java.nextDouble() for _ in range(100)]


def test_a_step_leaves_out_centers_that_are_far_from_a_group():
    """Every row was held against every centre, in the steps and in Spark ML's start."""
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.random((20_000, 2)), rng.integers(0, 4, 20_000)])
    order, ends = lloyd.grouped(x)
    assert sorted(order) == list(range(len(x))) and ends[-1] == len(x)
    rows, starts = x[order], np.concatenate(([0], ends[:-1]))
    groups = lloyd.Groups(rows, ends, np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts))
    centers = x[:200]
    left = lloyd._left(groups.low, groups.high, centers, (centers ** 2).sum(axis=1) / 2)
    assert left.sum(axis=1).mean() < len(centers) / 5
    assert (lloyd.nearest_of_groups(groups, centers) == lloyd.nearest_center(rows, centers)).all()
    # equal distances still go to the lower number
    twice = np.concatenate([centers, centers])
    assert lloyd.nearest_of_groups(groups, twice).max() < 200


def test_fits_of_a_sweep_share_their_passes(spark):
    rows = np.random.default_rng(4).normal(size=(800, 3)).tolist()
    df = points(spark, rows).repartition(3).cache()
    matrices = lloyd.packed(df, "v")
    alone = [lloyd.Lloyd(k, "v", "c", max_iter=6, tol=1e-4, seed=9).fit(df) for k in (2, 5, 9)]
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("lloyd-sweep", "three fits")
    together = lloyd.fitted(matrices, [2, 5, 9], "v", "c", max_iter=6, tol=1e-4, seed=9)
    sc.setLocalProperty("spark.jobGroup.id", None)
    for a, b in zip(alone, together):
        assert np.allclose(a.clusterCenters(), b.clusterCenters(), rtol=1e-9)
        assert a.summary.trainingCost == pytest.approx(b.summary.trainingCost) and a.summary.numIter == b.summary.numIter
    # passes: sizes, first row, two costs and draws, weights, six steps and the cost, some of them two jobs
    assert len(tracker.getJobIdsForGroup("lloyd-sweep")) <= 3 * (1 + 1 + 4 + 1 + 6 + 1)
    matrices.unpersist()
