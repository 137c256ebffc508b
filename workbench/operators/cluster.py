"""Clustering and anomaly detection: k-means pipelines (one-hot, scaling), cost and
label-entropy sweeps over k, cluster/label tables, fixed-centre assignment and
distance-threshold anomalies.

Sweeps prepare features once, pack them, and fit all k in the same passes over the rows
(``operators.lloyd``).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, RFormula, StandardScaler, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workbench.functions.bounded import only_row
from workbench.functions.partitions import spread
from workbench.functions.vectors import as_double_array, nearest, sqdist
from workbench.operators.lloyd import Lloyd, LloydModel, fitted, packed
from workbench.session import ensure_checkpoint_dir, materialised

# The k ranges swept by the cost and entropy studies.
K_SWEEP_SMALL = list(range(20, 101, 20))
K_SWEEP_LARGE = list(range(60, 271, 30))

SCALED = "scaled"  # the scaled feature vector's column


def one_hot_stages(*cols: str) -> tuple[list, list[str]]:
    """String columns → frequency-ordered indexes → one-hot vectors (last level dropped).
    One indexer for all columns: their levels are counted in one pass."""
    indexed, hot = ([f"{c}_{suffix}" for c in cols] for suffix in ("level", "hot"))
    return [StringIndexer(inputCols=list(cols), outputCols=indexed),
            OneHotEncoder(inputCols=indexed, outputCols=hot)], hot


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = (), *,
                   scale: bool = False, with_mean: bool = False,
                   features: str = "featureVector") -> tuple[list, str]:
    """Stages that turn the columns into one feature vector; returns (stages, column)."""
    from workbench.operators.classify import assembler
    stages: list = []
    cols = list(numeric)
    if categorical:
        stages, hot = one_hot_stages(*categorical)
        cols += hot
    stages.append(assembler(cols, features))
    if scale:
        stages.append(StandardScaler(inputCol=features, outputCol=SCALED, withStd=True,
                                     withMean=with_mean))
        features = SCALED
    return stages, features


def kmeans(k: int, features: str, *, max_iter: int = 20, tol: float = 1e-4,
           seed: int = 42) -> Lloyd:
    return Lloyd(k, features, "cluster", max_iter=max_iter, tol=tol, seed=seed)


def fit_clusters(df: DataFrame, k: int, *, numeric: Sequence[str],
                 categorical: Sequence[str] = (), scale: bool = True, with_mean: bool = False,
                 max_iter: int = 40, tol: float = 1e-5, seed: int = 42,
                 partitions: int | None = None) -> PipelineModel:
    """one-hot → assemble → scale → k-means, as one fitted pipeline. The used columns are
    dealt into parts (``partitions``: see ``spread``) and cached for the fit, which reads them
    for the stages, for the start and to pack them."""
    stages, feats = feature_stages(numeric, categorical, scale=scale, with_mean=with_mean)
    data = spread(df.select(*numeric, *categorical), partitions).cache()
    try:
        return Pipeline(stages=[*stages, kmeans(k, feats, max_iter=max_iter, tol=tol,
                                                seed=seed)]).fit(data)
    finally:
        data.unpersist()


def _prepared(df: DataFrame, numeric, categorical, scale, with_mean, keep=(),
              partitions: int | None = None):
    """The feature vectors over a checkpoint of the used columns, which keeps their parts and
    order. They are not cached: k-means packs them and reads the matrices."""
    stages, feats = feature_stages(numeric, categorical, scale=scale, with_mean=with_mean)
    ensure_checkpoint_dir(df.sparkSession)
    base = spread(df.select(*dict.fromkeys([*keep, *numeric, *categorical])), partitions).checkpoint()
    return Pipeline(stages=stages).fit(base).transform(base).select(*keep, feats), feats


# Most models of one sweep that are applied at the same time, and the rows of all of
# them together.
MAX_CONCURRENT_FITS, CONCURRENT_ROWS = 8, 8_000_000


def _each(ks: Sequence[int], run, parallelism: int | None, rows: int) -> list:
    """``run(k)`` for every k, several at a time unless ``rows`` alone fill the cluster."""
    workers = parallelism or min(len(ks), MAX_CONCURRENT_FITS, CONCURRENT_ROWS // max(rows, 1))
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(run, ks))


def _fits(data: DataFrame, features: str, ks: Sequence[int], parallelism: int | None, **rules) -> list[LloydModel]:
    """A model for each k, ``parallelism`` of them (all, unless given) in the same passes over the rows."""
    matrices, at_once = packed(data, features), parallelism or max(1, len(ks))
    try:
        return [m for i in range(0, len(ks), at_once)
                for m in fitted(matrices, ks[i:i + at_once], features, "cluster", **rules)]
    finally:
        matrices.unpersist()


def kmeans_sweep(df: DataFrame, ks: Sequence[int], *, numeric: Sequence[str],
                 categorical: Sequence[str] = (), scale: bool = False,
                 with_mean: bool = False, max_iter: int = 20, tol: float = 1e-4,
                 seed: int = 42, parallelism: int | None = None) -> DataFrame:
    """(k, cost, mean_cost) for each k: cost = Σ squared distance to the nearest
    centre (the model's training cost), mean_cost = cost / rows."""
    data, feats = _prepared(df, numeric, categorical, scale, with_mean)
    n = data.count()
    models = _fits(data, feats, ks, parallelism, max_iter=max_iter, tol=tol, seed=seed)
    rows = [(int(k), m.summary.trainingCost, m.summary.trainingCost / n) for k, m in zip(ks, models)]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, mean_cost double")


def cluster_entropy(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """One row (entropy, rows): label entropy of each cluster (natural log), weighted by
    cluster size, = Σ_{c,l} −n_cl·ln(n_cl / n_c) / N. One scan: the (cluster, label)
    counts come from an aggregation with map-side combine, and the cluster sizes are a
    window over those counts (a cluster's window holds one row per label it contains,
    not its rows)."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    sizes = F.sum("n").over(Window.partitionBy(cluster))
    terms = counts.select((-F.col("n") * F.log(F.col("n") / sizes)).alias("h"), "n")
    return terms.agg((F.sum("h") / F.sum("n")).alias("entropy"),
                     F.sum("n").alias("rows"))


def label_by_cluster(df: DataFrame, cluster: str = "cluster", label: str = "label"
                     ) -> DataFrame:
    """(cluster, label, count) ordered by cluster then label."""
    return (df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(cluster, label))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))


def entropy_sweep(df: DataFrame, ks: Sequence[int], *, numeric: Sequence[str],
                  categorical: Sequence[str] = (), label: str = "label",
                  scale: bool = True, max_iter: int = 40, tol: float = 1e-5,
                  seed: int = 42, parallelism: int | None = None) -> DataFrame:
    """(k, entropy): size-weighted label entropy of the clustering at each k."""
    data, feats = _prepared(df, numeric, categorical, scale, False, keep=[label])
    models = dict(zip(ks, _fits(data, feats, ks, parallelism, max_iter=max_iter, tol=tol, seed=seed)))

    def run(k: int) -> tuple[int, float]:
        return int(k), float(only_row(cluster_entropy(models[k].transform(data), "cluster", label))["entropy"])
    rows = _each(ks, run, parallelism, data.count())
    return df.sparkSession.createDataFrame(rows, "k int, entropy double")


# ---- fixed centres and anomalies ---------------------------------------------------
def group_centers(df: DataFrame, group: str, order: str, features: str) -> DataFrame:
    """(cluster, center): the features of each group's first row by ``order``, groups
    numbered from 0 in ascending order (a window over one row per group)."""
    firsts = df.groupBy(group).agg(F.min_by(as_double_array(features), F.col(order)).alias("center"))
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(group)) - 1
    return firsts.select(number.cast("int").alias("cluster"), "center")


def assign(df: DataFrame, features: str, centers: DataFrame | Sequence[Sequence[float]],
           cluster: str = "cluster", dist: str = "dist") -> DataFrame:
    """Nearest of the given centres, a table (cluster, center) or a list, and the squared
    distance to it; ties go to the lower cluster. The centres reach the rows as one array
    (a scalar subquery), and each distance is computed once."""
    if not isinstance(centers, DataFrame):
        centers = df.sparkSession.createDataFrame(
            [(i, [float(x) for x in c]) for i, c in enumerate(centers)],
            "cluster int, center array<double>")
    every = centers.agg(F.sort_array(F.collect_list(F.struct("cluster", "center")))).scalar()
    best = nearest(as_double_array(features), F.col("_centers"))
    return (df.withColumn("_centers", every).withColumn("_best", best).withColumn(cluster, F.col("_best.cluster"))
            .withColumn(dist, F.col("_best.dist")).drop("_best", "_centers"))


def distance_to_model_center(clustered: DataFrame, model: LloydModel, features: str,
                             cluster: str = "cluster", dist: str = "dist") -> DataFrame:
    """Squared distance of each row to its own cluster's centre: a broadcast join of
    the k centres (k is the model size) on the cluster id."""
    spark = clustered.sparkSession
    centers = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        f"{cluster} int, _center array<double>")
    return (clustered.join(F.broadcast(centers), cluster)
            .withColumn(dist, sqdist(vector_to_array(features), F.col("_center")))
            .drop("_center"))


def anomalies(scored: DataFrame, dist: str = "dist", k: int = 100,
              keep: Sequence[str] | None = None) -> DataFrame:
    """Rows whose distance is at least the k-th largest distance (ties kept; with
    fewer than k rows the smallest distance). The threshold is a scalar subquery over
    a top-k (partial top-k per task, then a k-row merge). The distances are computed
    once: the threshold and the result read the same stored rows."""
    scored = materialised(scored.select(*dict.fromkeys([*(keep or scored.columns), dist])), "distances")
    top = scored.select(dist).orderBy(F.col(dist).desc()).limit(k)
    threshold = top.agg(F.min(dist)).scalar()
    out = scored.where(F.col(dist) >= threshold)
    return out.select(*keep) if keep is not None else out


def formula_kmeans(df: DataFrame, k: int = 100, *, formula: str = "~ .", max_iter: int = 40,
                   seed: int = 42, partitions: int | None = None) -> PipelineModel:
    """R-style ``~ .`` features (every column; strings one-hot) → k-means."""
    rf = RFormula(formula=formula, featuresCol="features")
    fit = Lloyd(k, "features", "prediction", max_iter=max_iter, tol=1e-4, seed=seed)
    return Pipeline(stages=[rf, fit]).fit(spread(df, partitions))
