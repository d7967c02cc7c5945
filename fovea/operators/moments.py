"""Mean and covariance of feature arrays in one pass, and a small table that stands in for them.

Scaling and PCA depend on the data only through its mean and covariance. Taking these once replaces
the scaler's pass and two passes per PCA fit; the estimators then run on a table of 2 x width rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fovea.session import ship_package

# Values multiplied at a time, 32 MB as doubles.
BLOCK_VALUES = 4_000_000
# Partial results that one task merges.
FAN_IN = 64


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    covariance: np.ndarray
    _axes: dict = field(default_factory=dict, repr=False)

    @property
    def deviations(self) -> np.ndarray:
        return np.sqrt(np.diag(self.covariance))

    def standardized_covariance(self) -> np.ndarray:
        """Covariance of the vectors divided by their deviations; constant dimensions are zero."""
        inverse = np.zeros_like(self.mean)
        np.divide(1.0, self.deviations, out=inverse, where=self.deviations > 0)
        return self.covariance * np.outer(inverse, inverse)

    def principal_axes(self, standardized: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(variances, axes as columns), smallest first, of the raw or the standardized vectors.

        Decomposed once; the variance curve and the stand-in table share it.
        """
        if standardized not in self._axes:
            matrix = self.standardized_covariance() if standardized else self.covariance
            self._axes[standardized] = np.linalg.eigh(matrix)
        return self._axes[standardized]


def _as_arrays(df: DataFrame, column: str) -> DataFrame:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return df.select(vector_to_array(column).alias("x"))
    return df.select(F.col(column).alias("x"))


PARTIAL = "task bigint, dim int, n bigint, mean array<double>, products array<double>"


def _add(state: tuple | None, n: int, mean: np.ndarray, products: np.ndarray) -> tuple:
    """Two groups' counts, means and centred products as one group's.

    `products` may be the whole matrix, or its row of the first dimension in `mean`.
    """
    if state is None:
        return n, mean, products
    n0, mean0, products0 = state
    delta = mean - mean0
    share = n0 * n / (n0 + n)
    cross = np.outer(delta, delta) if products.ndim == 2 else delta[0] * delta
    return n0 + n, mean0 + delta * (n / (n0 + n)), products0 + products + share * cross


def _partials(arrays: DataFrame) -> DataFrame:
    """One row per task and dimension: the means and centred products from that dimension on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, width = None, None
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            width = int(sizes[0]) if width is None else width
            if (sizes != width).any():
                raise ValueError(f"not every row has {width} dimensions")
            step = max(BLOCK_VALUES // max(width, 1), 1)
            for start in range(0, len(lists), step):
                flat = lists.slice(start, step).flatten().to_numpy(zero_copy_only=False)
                rows = flat.reshape(-1, width).astype(np.float64)
                # about its own first row, so that a constant dimension stays exactly constant
                first = rows[0].copy()
                rows -= first
                mean = rows.mean(axis=0)
                rows -= mean
                state = _add(state, len(rows), first + mean, rows.T @ rows)
        if state is not None:
            n, mean, products = state
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * width, pa.int64()),
                    pa.array(range(width), pa.int32()),
                    pa.array([n] * width, pa.int64()),
                    pa.array([mean[i:] for i in range(width)], pa.list_(pa.float64())),
                    pa.array([products[i, i:] for i in range(width)], pa.list_(pa.float64())),
                ],
                ["task", "dim", "n", "mean", "products"],
            )

    return arrays.mapInArrow(run, PARTIAL)


def _merge(table: pa.Table) -> pa.Table:
    """The rows of one dimension as one row, in the order of tasks."""
    table = table.sort_by("task")
    state = None
    for batch in table.to_batches():
        for n, mean, products in zip(*(batch.column(c) for c in ("n", "mean", "products"))):
            values = (x.values.to_numpy(zero_copy_only=False) for x in (mean, products))
            if state is not None and len(state[1]) != len(mean):
                raise ValueError("not every row has the same number of dimensions")
            state = _add(state, n.as_py(), *values)
    n, mean, products = state
    lists = pa.list_(pa.float64())
    columns = [table.column("task")[0].as_py() // FAN_IN], [table.column("dim")[0].as_py()], [n]
    return pa.table([*columns, pa.array([mean], lists), pa.array([products], lists)], table.schema)


def moment_rows(df: DataFrame, column: str) -> DataFrame:
    """(dim, n, mean, products): per dimension the row count, and the means and centred products from
    that dimension on. All rows have to be of one width and without NULLs.

    Each task multiplies its batches and sends half a matrix, a row per dimension. At most `FAN_IN`
    of a dimension's rows are merged by one task, and what is left of them by another one.
    """
    ship_package(df.sparkSession)
    partials = _partials(_as_arrays(df, column))
    nearby = F.floor(F.col("task") / FAN_IN).alias("near")
    for keys in (("dim", nearby), ("dim",)):
        partials = partials.groupBy(*keys).applyInArrow(_merge, PARTIAL)
    return partials.drop("task")


def feature_moments(df: DataFrame, column: str) -> Moments:
    """Sample moments of an array or vector column without NULLs, all rows of one width, in one pass."""
    rows = {row["dim"]: row for row in moment_rows(df, column).collect()}
    if not rows:
        raise ValueError("no rows to take moments of")
    n, mean = rows[0]["n"], np.array(rows[0]["mean"])
    if n < 2:
        raise ValueError("a covariance needs at least two rows")
    products = np.zeros((len(mean), len(mean)))
    for i, row in rows.items():
        products[i, i:] = products[i:, i] = row["products"]
    return Moments(n, mean, products / (n - 1))


def covariance_rows(df: DataFrame, column: str) -> DataFrame:
    """Sample covariance as rows (i, j, covariance), none of it on the driver."""
    upper = moment_rows(df, column).select(
        F.col("dim").alias("i"), "n", F.posexplode("products").alias("at", "product")
    )
    value = (F.col("product") / (F.col("n") - 1)).alias("covariance")
    j = (F.col("i") + F.col("at")).cast("int")
    cell = F.struct(F.col("i").alias("i"), j.alias("j"))
    mirrored = F.struct(j.alias("i"), F.col("i").alias("j"))
    cells = F.when(F.col("at") == 0, F.array(cell)).otherwise(F.array(cell, mirrored))
    return upper.select(F.explode(cells).alias("cell"), value).select("cell.i", "cell.j", "covariance")


def stand_in(
    moments: Moments, spark: SparkSession, output_col: str = "vectors", standardized: bool = False
) -> DataFrame:
    """2 x width vectors with the given mean and covariance.

    They lie on both ends of the principal axes around the mean, the raw ones or, stretched by the
    deviations, the standardized ones. Few tasks take them: on a large cluster every core would
    get a row of its own and send back a matrix.
    """
    variances, axes = moments.principal_axes(standardized)
    arms = (axes * np.sqrt(np.clip(variances, 0, None))).T
    if standardized:
        arms = arms * moments.deviations
    arms[:, np.diag(moments.covariance) <= 0] = 0.0
    arms *= np.sqrt((2 * len(arms) - 1) / 2)
    points = np.concatenate([moments.mean + arms, moments.mean - arms])
    table = pa.table({"x": pa.array(list(points), pa.list_(pa.float64()))})
    points = spark.createDataFrame(table).coalesce(max(len(arms) // 256, 1))
    return points.select(array_to_vector("x").alias(output_col))
