"""Implicit-feedback recommendation: play-count tables, alias resolution, the factor
model (Spark ML ALS), batch top-N and a popularity baseline."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.functions.joins import lookup_or_self
from workbench.operators.factor_scores import top_items
from workbench.session import ensure_checkpoint_dir
from workbench.sources import lines as L

Predictor = Callable[[DataFrame], DataFrame]


def build_counts(play_lines: DataFrame, alias: DataFrame | None = None, *,
                 user: str = "user", item: str = "artist", count: str = "count",
                 aggregate: bool = False) -> DataFrame:
    """``user item count`` lines → (user, item, count) with misspelt item ids replaced
    by their canonical id (one hop; unknown ids kept). Bad lines fail the job.

    ``alias`` is (artist, alias). Duplicate (user, item) pairs that appear after the
    remap are kept as separate rows unless ``aggregate``."""
    counts = L.parse_fields_strict(play_lines, [user, item, count], sep=" ", exact=True)
    if alias is not None:
        a = alias.groupBy("artist").agg(F.max("alias").alias("alias"))  # last one wins
        counts = lookup_or_self(counts, item, a, "artist", "alias")
    if aggregate:
        counts = counts.groupBy(user, item).agg(F.sum(count).cast("int").alias(count))
    return counts


def resolve_aliases(df: DataFrame, alias: DataFrame, item: str) -> DataFrame:
    """Replace ids in ``df[item]`` by their canonical id from (artist, alias)."""
    a = alias.groupBy("artist").agg(F.max("alias").alias("alias"))
    return lookup_or_self(df, item, a, "artist", "alias")


# Steps of a fit between two checkpoints of the item factors, and seconds between two requests
# to drop what no step refers to any more. Neither changes the model.
CHECKPOINT_STEPS, DROP_SECONDS = 2, 5.0
_asking = threading.Lock()


@contextmanager
def _dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of finished steps are removed while the block runs. Each step leaves the
    factors that it sent on the executors' disks; a checkpoint ends the lineage that needs them,
    and Spark removes them once the driver's garbage collector has seen that. A driver with
    memory to spare collects too seldom, so it is asked to."""
    done = threading.Event()

    def ask() -> None:
        while not done.wait(DROP_SECONDS):
            # fits that run at the same time ask once for all of them
            if _asking.acquire(blocking=False):
                try:
                    spark._jvm.System.gc()
                    done.wait(DROP_SECONDS / 2)
                finally:
                    _asking.release()

    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    try:
        yield
    finally:
        done.set()
        asking.join()
        spark._jvm.System.gc()


def fit_als(train: DataFrame, *, rank: int = 10, reg: float = 0.01, alpha: float = 1.0,
            max_iter: int = 5, seed: int = 42, user: str = "user", item: str = "artist",
            rating: str = "count", blocks: int | None = None) -> ALSModel:
    """Implicit-preference matrix factorisation. Ids must fit in int. Cold-start rows
    predict NaN (turned into null by the evaluators)."""
    als = (ALS(implicitPrefs=True, rank=rank, regParam=reg, alpha=alpha, maxIter=max_iter,
               seed=seed, userCol=user, itemCol=item, ratingCol=rating,
               coldStartStrategy="nan", checkpointInterval=CHECKPOINT_STEPS).setPredictionCol("prediction"))
    if blocks:
        als = als.setNumBlocks(blocks)
    ensure_checkpoint_dir(train.sparkSession)
    with _dropped_shuffles(train.sparkSession):
        return als.fit(train)


def als_predictor(model: ALSModel) -> Predictor:
    return lambda df: model.transform(df)


def factors(model: ALSModel, which: str = "user") -> DataFrame:
    """(id, features array<float>) of users or items."""
    return model.userFactors if which == "user" else model.itemFactors


def top_n(model: ALSModel, n: int, users: DataFrame | None = None, *,
          exclude_seen: DataFrame | None = None, user: str = "user",
          item: str = "artist") -> DataFrame:
    """Top ``n`` items per user as rows (user, rank, item, prediction), all users in one
    job (block-wise cross product inside ALS, bounded top-k per user), or only the
    users in ``users``. Items the user already has are not excluded, unless
    ``exclude_seen`` holds them as (user, item) rows: then the exact search of
    ``factor_scores.top_items`` leaves them out, however many a user has."""
    if exclude_seen is not None:
        wanted = model.userFactors
        if users is not None:
            wanted = wanted.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
        return top_items(wanted, model.itemFactors, n, exclude=exclude_seen, user=user, item=item)
    recs = (model.recommendForUserSubset(users.select(user).distinct(), n)
            if users is not None else model.recommendForAllUsers(n))
    return (recs.select(F.col(user), F.posexplode("recommendations").alias("pos", "r"))
            .select(user, (F.col("pos") + 1).alias("rank"),
                    F.col(f"r.{item}").alias(item),
                    F.col("r.rating").cast("double").alias("prediction")))


def recommend_for_user(model: ALSModel, user_id: int, n: int, *, user: str = "user",
                       item: str = "artist") -> DataFrame:
    """Top ``n`` (item, prediction) for one user: every item paired with the user as a
    constant column, scored by the model, then a bounded top-n (ties by item id)."""
    candidates = model.itemFactors.select(F.col("id").alias(item)).withColumn(
        user, F.lit(user_id))
    return (model.transform(candidates).select(item, "prediction")
            .orderBy(F.col("prediction").desc(), F.col(item)).limit(n))


def popularity_predictor(train: DataFrame, *, user: str = "user", item: str = "artist",
                         count: str = "count") -> Predictor:
    """Score = total plays of the item in ``train`` (null for unseen items); the
    predictor adds ``prediction`` to the rows it is given (input columns kept)."""
    listens = train.groupBy(item).agg(F.sum(count).alias("prediction"))

    def predict(df: DataFrame) -> DataFrame:
        cols = [c for c in df.columns if c != "prediction"]
        return df.select(*cols).join(listens, [item], "left").select(*cols, "prediction")
    return predict


def history(plays: DataFrame, items: DataFrame, users: Sequence[int] | DataFrame, *,
            user: str = "user", item: str = "artist", id_col: str = "id") -> DataFrame:
    """Catalogue rows of the items the given users have (a semi-join, no collect)."""
    if not isinstance(users, DataFrame):
        sel = plays.where(F.col(user).isin(list(users)))
    else:
        sel = plays.join(users.select(user), [user], "left_semi")
    seen = sel.select(F.col(item).alias(id_col))
    return items.join(seen, [id_col], "left_semi")
