"""Low-dimensional views of numeric data: seeded random projection and PCA."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workbench.functions.vectors import as_double_array, dot, literal_vector


def projection_matrix(dims_in: int, dims_out: int = 3, seed: int = 42) -> np.ndarray:
    """dims_in × dims_out standard-normal matrix whose rows (one per input feature)
    are scaled to unit length. Built on the driver: its size is the schema's."""
    m = np.random.default_rng(seed).standard_normal((dims_in, dims_out))
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def random_projection(df: DataFrame, features: str, dims_in: int, dims_out: int = 3,
                      seed: int = 42, prefix: str = "x") -> DataFrame:
    """Add ``x1..x{dims_out}`` = features · matrix column j, for every row."""
    m = projection_matrix(dims_in, dims_out, seed)
    arr = as_double_array(features)
    out = df
    for j in range(dims_out):
        out = out.withColumn(f"{prefix}{j + 1}", dot(arr, literal_vector(m[:, j])))
    return out


def pca_scores(df: DataFrame, features: str, k: int = 3, keep: Sequence[str] = ()
               ) -> tuple[DataFrame, DataFrame]:
    """Centre and scale the features, then PCA: (scores pc1..pck per row,
    (component, explained_variance)). ``features`` is a vector column."""
    scaler = StandardScaler(inputCol=features, outputCol="_scaled", withMean=True, withStd=True)
    pca = PCA(k=k, inputCol="_scaled", outputCol="_pcs")
    model = Pipeline(stages=[scaler, pca]).fit(df)
    arr = vector_to_array(F.col("_pcs"))
    scores = model.transform(df).select(*keep, *[arr[i].alias(f"pc{i + 1}") for i in range(k)])
    ev = model.stages[-1].explainedVariance.toArray().tolist()
    variance = df.sparkSession.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(ev)], "component int, explained_variance double")
    return scores, variance
