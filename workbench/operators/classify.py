"""Multiclass classification with Spark ML: feature assembly, one-hot undo, decision
trees, random forests, categorical indexing, importances and grid search.

Fitting is Spark ML's own distributed tree induction (binned statistics aggregated per
node across executors), and for deep trees ``operators.deeptree``, which gives the same
tree; this module wires the stages and turns results into tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workbench.functions.bounded import only_row
from workbench.functions.partitions import spread
from workbench.functions.vectors import first_hot_index
from workbench.operators.deeptree import DeepTree, prepared


def feature_columns(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """All columns but the label (and ``exclude``), in table order."""
    return [c for c in df.columns if c != label and c not in exclude]


def assembler(cols: Sequence[str], out: str = "featureVector",
              handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def undo_one_hot(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each group of 0/1 indicator columns by one column holding the index of
    the first column equal to 1 (−1.0 when none is), as a double. The new columns go
    last, in the order of ``groups``."""
    out = df
    for name, cols in groups.items():
        out = out.withColumn(name, first_hot_index(cols)).drop(*cols)
    return out


# Deepest tree that Spark ML grows, and the parameters that a deeper one may have.
LEVELWISE_DEPTH = 10
DEEP_PARAMS = {"impurity", "maxDepth", "maxBins", "minInfoGain"}


def tree(label: str, features: str = "featureVector", seed: int = 42, **params
         ) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features,
                                  predictionCol="prediction", seed=seed, **params)


def forest(label: str, features: str = "featureVector", seed: int = 42, **params
           ) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features,
                                  predictionCol="prediction", seed=seed, **params)


# Most classes of a label, as in Spark ML.
MAX_CLASSES = 100


def with_class_count(df: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """``df``, the dealt ``rows``, with the number of classes in the label's metadata, where its largest value is a
    class number: a fit that does not find it there reads all rows once more to look."""
    top = only_row(rows.agg(F.max(F.col(label).cast("double"))))[0]
    if top is None or not 0 <= top < MAX_CLASSES or top != int(top):
        return df
    attr = {"ml_attr": {"type": "nominal", "num_vals": int(top) + 1}}
    return df.withColumn(label, F.col(label).alias(label, metadata=attr))


def _fitted(stages: list, df: DataFrame, label: str, partitions: int | None) -> PipelineModel:
    """The stages fitted on the dealt rows, which are cached for the fit: it reads them for its
    log, its metadata, the limits of the bins and the nodes, and would deal them out again or
    read them over the network each time."""
    dealt = with_class_count(spread(df, partitions), df, label).cache()
    try:
        return Pipeline(stages=stages).fit(dealt)
    finally:
        dealt.unpersist()


def fit_tree(df: DataFrame, label: str, features: Sequence[str] | None = None, *,
             seed: int = 42, partitions: int | None = None, **params) -> PipelineModel:
    """assemble → decision tree (``partitions``: see ``spread``)."""
    cols = list(features) if features else feature_columns(df, label)
    if params.get("maxDepth", 0) > LEVELWISE_DEPTH and set(params) <= DEEP_PARAMS:
        make = assembler(cols)
        rows = make.transform(df)
        ready = prepared(rows, "featureVector", label, params.get("maxBins", 32), seed,
                         lambda: make.transform(spread(df, partitions)))
        return PipelineModel(stages=[make, DeepTree(label, seed=seed, ready=ready, **params).fit(rows)])
    return _fitted([assembler(cols), tree(label, seed=seed, **params)], df, label, partitions)


def check_bins(df: DataFrame, cols: Sequence[str], max_categories: int, max_bins: int) -> None:
    """maxBins must cover the largest categorical feature (≤ max_categories values)."""
    if max_bins < max_categories:
        # the indexer may declare up to max_categories values for a feature
        seen = (df.select(F.explode(F.map_from_arrays(
                    F.array(*[F.lit(c) for c in cols]),
                    F.array(*[F.col(c).cast("double") for c in cols]))).alias("feature", "value"))
                .distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("n")))
        widest = only_row(seen.where(F.col("n") <= max_categories).agg(F.max("n")))[0] or 0
        if widest > max_bins:
            raise ValueError(f"maxBins={max_bins} is below a categorical feature with "
                             f"{widest} values; raise maxBins to at least {widest}")


def categorical_stages(cols: Sequence[str], max_categories: int = 40
                       ) -> list:
    return [assembler(cols),
            VectorIndexer(maxCategories=max_categories, inputCol="featureVector",
                          outputCol="indexedVector", handleInvalid="keep")]


def fit_categorical(df: DataFrame, label: str, *, model: str = "tree",
                    max_categories: int = 40, max_bins: int = 50, seed: int = 42,
                    partitions: int | None = None, **params) -> PipelineModel:
    """assemble → index slots with ≤ max_categories values as categories → tree or
    forest on the indexed vector."""
    cols = feature_columns(df, label)
    check_bins(df, cols, max_categories, max_bins)
    make = tree if model == "tree" else forest
    est = make(label, "indexedVector", seed=seed, maxBins=max_bins, **params)
    return _fitted([*categorical_stages(cols, max_categories), est], df, label, partitions)


def importances(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of the last stage, largest first. The vector has one
    entry per feature, so it is as small as the schema."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    rows = list(zip(list(names), [float(v) for v in imp]))
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.col("importance").desc(), F.col("feature").desc()))


def predictions(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns + prediction + class probabilities as array<double>."""
    out = model.transform(df)
    return out.select(*keep, "prediction",
                      vector_to_array("probability").alias("probability"))


def evaluator(label: str, metric: str = "accuracy") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName=metric)


# The 2×2×2×2 grid of the tree search.
GRID_IMPURITY = ["gini", "entropy"]
GRID_DEPTH = [1, 20]
GRID_BINS = [40, 300]
GRID_MIN_GAIN = [0.0, 0.05]


def tree_grid_search(df: DataFrame, label: str, *, train_ratio: float = 0.9,
                     seed: int = 42, parallelism: int = 4,
                     partitions: int | None = None) -> tuple[DataFrame, PipelineModel]:
    """Train/validation search over impurity × depth × bins × min-gain (16 fits, run
    ``parallelism`` at a time). Returns (metrics table sorted best first, best model). Rows are
    binned once for each number of bins; the best point is fitted again on all rows."""
    make = assembler(feature_columns(df, label))
    data = make.transform(spread(df, partitions)).select(
        "featureVector", label, F.rand(seed).alias("_draw")).cache()
    try:
        train, held = data.where(F.col("_draw") < train_ratio), data.where(F.col("_draw") >= train_ratio)
        ready = {b: prepared(train, "featureVector", label, b, seed) for b in GRID_BINS}
        grid = [(i, d, b, g) for i in GRID_IMPURITY for d in GRID_DEPTH for b in GRID_BINS for g in GRID_MIN_GAIN]

        def fit(point, rows, binned):
            impurity, depth, bins, gain = point
            return DeepTree(label, seed=seed, impurity=impurity, maxDepth=depth, maxBins=bins,
                            minInfoGain=gain, ready=binned).fit(rows)

        def score(point) -> float:
            return evaluator(label).evaluate(fit(point, train, ready[point[2]]).transform(held))

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            scores = list(pool.map(score, grid))
        chosen = grid[int(np.argmax(scores))]
        best = fit(chosen, data, prepared(data, "featureVector", label, chosen[2], seed))
    finally:
        data.unpersist()
    table = df.sparkSession.createDataFrame(
        [(*p, float(x)) for p, x in zip(grid, scores)],
        "impurity string, maxDepth int, maxBins int, minInfoGain double, accuracy double")
    return table.orderBy(F.col("accuracy").desc()), PipelineModel(stages=[make, best])
