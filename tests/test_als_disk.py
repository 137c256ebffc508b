"""What a factor-model fit leaves on disk while it runs."""

import os
import threading

from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from workbench.operators import recommend


def _counts(spark, n=40_000):
    return spark.range(n, numPartitions=4).select(
        F.pmod(F.xxhash64("id"), F.lit(1500)).cast("int").alias("user"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1500)).cast("int").alias("artist"),
        (1 + F.col("id") % 7).cast("int").alias("count"))


def _shuffles(spark):
    """Shuffle files in the folders of this session, which runs all its tasks itself."""
    found = set()
    for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for _, _, files in os.walk(d.getPath()):
            found.update(f for f in files if f.startswith("shuffle_") and f.endswith(".data"))
    return found


def test_steps_leave_no_shuffle_files(spark, monkeypatch):
    """During a fit of many steps the files of finished ones go; all of them stayed before."""
    monkeypatch.setattr(recommend, "DROP_SECONDS", 0.3)
    train = _counts(spark).cache()
    train.count()
    before, seen, now, done = _shuffles(spark), set(), [], threading.Event()

    def watch():
        while not done.wait(0.2):
            there = _shuffles(spark) - before
            seen.update(there)
            now.append(len(there))
    watching = threading.Thread(target=watch)
    watching.start()
    try:
        model = recommend.fit_als(train, rank=8, max_iter=40, seed=3)
    finally:
        done.set()
        watching.join()
    train.unpersist()
    assert model.userFactors.count() == 1500
    assert max(now) < len(seen) / 2


def test_checkpoints_do_not_change_the_model(spark):
    train = _counts(spark, 5_000)
    ours = recommend.fit_als(train, rank=4, max_iter=6, seed=3)
    plain = ALS(implicitPrefs=True, rank=4, regParam=0.01, alpha=1.0, maxIter=6, seed=3, userCol="user",
                itemCol="artist", ratingCol="count", coldStartStrategy="nan").fit(train)
    a, b = ({r["id"]: r["features"] for r in m.itemFactors.collect()} for m in (ours, plain))
    assert a.keys() == b.keys()
    assert all(abs(x - y) < 1e-4 for k in a for x, y in zip(a[k], b[k]))
