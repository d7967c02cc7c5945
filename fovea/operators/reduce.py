"""Scaling, PCA, the explained-variance curve, and the choice of the number of components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    PCA,
    ElementwiseProduct,
    PCAModel,
    StandardScaler,
    StandardScalerModel,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.functions.tensors import feature_reject_reason
from fovea.operators.moments import Moments, covariance_rows, feature_moments, stand_in

# the widest covariance MLlib computes
MAX_WIDTH = 65_535


def with_vectors(
    df: DataFrame, features_col: str = "features", output_col: str = "vectors"
) -> DataFrame:
    """Add the feature array as an ML vector, converted in the JVM.

    A NULL array is an error when the rows are computed; `split_features` tells such rows apart.
    """
    present = F.coalesce(
        F.col(features_col),
        F.raise_error(F.lit(f"{features_col} is NULL; split_features tells such rows apart")).cast(
            df.schema[features_col].dataType
        ),
    )
    return df.withColumn(output_col, array_to_vector(present))


def feature_width(df: DataFrame, features_col: str) -> int:
    """The most frequent width of the feature arrays; empty ones count last, of equals the larger."""
    present = df.where(F.col(features_col).isNotNull())
    sizes = present.groupBy(F.size(features_col).alias("n")).agg(F.count("*").alias("rows"))
    row = sizes.orderBy(F.desc(F.col("n") > 0), F.desc("rows"), F.desc("n")).first()
    if row is None:
        raise ValueError("no rows to take the feature width from")
    return row["n"]


def split_features(
    df: DataFrame, features_col: str = "features", width: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that can enter a fit, the other ones with `reject_reason`).

    Without `width`, the most frequent one is asked for.
    """
    if width is None:
        width = feature_width(df, features_col)
    reason = feature_reject_reason(features_col, width)
    rejected = df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
    return df.where(reason.isNull()), rejected


def vector_width(df: DataFrame, vector_col: str) -> int:
    """Width of the vectors: from column metadata if a stage left it there, else of one row."""
    width = df.schema[vector_col].metadata.get("ml_attr", {}).get("num_attrs")
    if width is None:
        row = df.select(F.size(vector_to_array(vector_col)).alias("n")).first()
        if row is None:
            raise ValueError("no rows to take the vector width from")
        width = row["n"]
    return width


def fit_scaler(
    df: DataFrame,
    input_col: str = "vectors",
    output_col: str = "vectors_std",
    with_mean: bool = False,
    with_std: bool = True,
) -> StandardScalerModel:
    """Per-dimension sample standard deviation; by default vectors are scaled, not centred."""
    return StandardScaler(
        inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std
    ).fit(df)


def scaler_stats(model: StandardScalerModel, spark: SparkSession) -> DataFrame:
    """(dim, mean, std) of a fitted scaler."""
    rows = [
        (dim, float(mean), float(std))
        for dim, (mean, std) in enumerate(zip(model.mean.toArray(), model.std.toArray()))
    ]
    return spark.createDataFrame(rows, "dim int, mean double, std double")


def fit_pca(
    df: DataFrame, input_col: str = "vectors", output_col: str = "pca", k: int | None = None
) -> PCAModel:
    """PCA with `k` components, all of them by default.

    Fitting centres the data, transforming does not. Executors sum partial moments; the driver
    holds one width x width matrix, which is what bounds the width.
    """
    if k is None:
        k = vector_width(df, input_col)
    if k > MAX_WIDTH:
        raise ValueError(f"{k} columns; PCA takes at most {MAX_WIDTH}")
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df)


def covariance_table(df: DataFrame, column: str = "vectors") -> DataFrame:
    """Sample covariance as rows (i, j, covariance)."""
    return covariance_rows(df, column)


def scree(model: PCAModel, spark: SparkSession) -> DataFrame:
    """(component from 1, share of variance, running total) of a fitted PCA."""
    return _scree_table(model.explainedVariance.toArray(), spark)


def scree_of(moments: Moments, spark: SparkSession, standardized: bool = False) -> DataFrame:
    """The curve of the raw or the standardized vectors with these moments."""
    variances = np.clip(moments.principal_axes(standardized)[0][::-1], 0, None)
    total = variances.sum()
    if not total > 0:
        raise ValueError("the vectors have no variance")
    return _scree_table(variances / total, spark)


def scree_pair(
    df: DataFrame, column: str = "vectors", moments: Moments | None = None
) -> tuple[DataFrame, DataFrame]:
    """The curves of the raw and of the standardized vectors, from one pass over the data, or none
    where the moments are known."""
    moments = moments or feature_moments(df, column)
    spark = df.sparkSession
    return scree_of(moments, spark), scree_of(moments, spark, standardized=True)


def _scree_table(shares: np.ndarray, spark: SparkSession) -> DataFrame:
    # one row per dimension, and the shares are here already: no job for a running total
    rows = [
        (i + 1, float(share), float(total))
        for i, (share, total) in enumerate(zip(shares, np.cumsum(shares)))
    ]
    return spark.createDataFrame(
        rows, "component int, explained_variance double, cumulative double"
    )


def first_reaching(scree_table: DataFrame, threshold: float = 0.99) -> DataFrame:
    """One row (k, reached): the smallest component count whose total is at least `threshold`,
    NULL if there is none."""
    return scree_table.where(F.col("cumulative") >= threshold).agg(
        F.min("component").alias("k"),
        F.min_by("cumulative", "component").alias("reached"),
    )


def select_k(scree_table: DataFrame, threshold: float = 0.99, if_never: str = "raise") -> int:
    """`first_reaching` as a number; `if_never='all'` keeps every component instead of raising.

    Looks through the curve here: it has one row per dimension and is no work for a job.
    """
    totals = {row["component"]: row["cumulative"] for row in scree_table.collect()}
    reaching = [component for component, total in totals.items() if total >= threshold]
    if reaching:
        return min(reaching)
    if if_never != "all":
        raise ValueError(f"the components never reach {threshold} of the variance")
    return len(totals)


def compare_scree(raw: DataFrame, standardized: DataFrame) -> DataFrame:
    """Both curves side by side. Broadcast: at most one row per dimension, see MAX_WIDTH."""
    left = raw.select("component", F.col("cumulative").alias("raw_cumulative"))
    right = standardized.select("component", F.col("cumulative").alias("std_cumulative"))
    return left.join(F.broadcast(right), "component").withColumn(
        "delta", F.col("std_cumulative") - F.col("raw_cumulative")
    )


def scree_zoom(scree_table: DataFrame, threshold: float = 0.99, last: int = 31) -> DataFrame:
    """The start of the curve, with a flag where it is at or above the threshold line."""
    return scree_table.where(F.col("component") <= last).withColumn(
        "above_threshold", F.col("cumulative") >= threshold
    )


def component_signs(model: PCAModel) -> np.ndarray:
    """+1 or -1 per component, so that its first non-zero loading becomes positive.

    A solver may return either direction of an eigenvector; this makes results comparable.
    """
    loadings = model.pc.toArray()
    first = (np.abs(loadings) > 1e-12).argmax(axis=0)
    values = loadings[first, np.arange(loadings.shape[1])]
    return np.where(values < 0, -1.0, 1.0)


def truncate_pca(model: PCAModel, k: int, output_col: str) -> PipelineModel:
    """The first `k` components of a full PCA, signs fixed, without fitting again.

    The full projection costs width**2 multiplications a row; a second fit would cost half of that
    plus another pass over the data.
    """
    head = f"{output_col}_head"
    cut = VectorSlicer(inputCol=model.getOutputCol(), outputCol=head, indices=list(range(k)))
    return PipelineModel(stages=[model, cut, _sign_stage(model, k, head, output_col)])


def _sign_stage(model: PCAModel, k: int, input_col: str, output_col: str) -> ElementwiseProduct:
    signs = Vectors.dense(component_signs(model)[:k])
    return ElementwiseProduct(scalingVec=signs, inputCol=input_col, outputCol=output_col)


@dataclass
class Reduction:
    """A fitted reduction: transformer, chosen number of components, explained-variance curve, and how many
    rows could not enter the fit, by reason, where they were counted."""

    model: PipelineModel
    k: int
    scree: DataFrame
    rejected: dict[str, int] | None = None


def fit_reduction(
    df: DataFrame,
    input_col: str = "vectors",
    output_col: str = "features_pca",
    standardize: bool = True,
    with_mean: bool = False,
    threshold: float = 0.99,
    if_never: str = "raise",
    features_col: str | None = None,
    moments: Moments | None = None,
    k: int | None = None,
) -> Reduction:
    """Scale (optional), choose k from the explained variance, project on k components.

    Reads `df` once, for its moments (from `features_col` where the vectors also exist as arrays);
    scaler and PCA are fitted on the table that stands in for them, whatever the width. With `moments`
    given, as when a raw and a standardized reduction are fitted side by side, it is not read at
    all. `k` fixes the number of components. Give it a staged table.
    """
    spark, stages, source = df.sparkSession, [], input_col
    moments = moments or feature_moments(df, features_col or input_col)
    curve = scree_of(moments, spark, standardize)
    k = k or select_k(curve, threshold, if_never)
    data = stand_in(moments, spark, input_col, standardize)
    if standardize or with_mean:
        source = f"{input_col}_std"
        stages.append(fit_scaler(data, input_col, source, with_mean, with_std=standardize))
        data = stages[-1].transform(data)
    full = f"{output_col}_full"
    pca = fit_pca(data, source, full, k)
    stages += [pca, _sign_stage(pca, k, full, output_col)]
    return Reduction(PipelineModel(stages=stages), k, curve)
