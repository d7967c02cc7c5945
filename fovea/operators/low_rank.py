"""The first principal axes of wide vectors, without their covariance matrix.

The exact fit (`moments`, `reduce`) holds a width x width matrix in every task and in the driver, which ends
at some thousands of columns. Here a basis of `rank + oversample` directions is multiplied by the
covariance once per pass over the data: a task keeps its count, mean, sums of squares and the product of
its centred rows with the basis, width x basis numbers in all, and two tasks' results are merged
as exactly as two groups' covariances are. Partial results travel in chunks of dimensions, at most `FAN_IN`
of a chunk are merged by one task, and the driver makes the product the next basis (randomised
subspace iteration). It stops when the axes' residuals are small, and says how large they are: a variance
is off by no more than its residual, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fovea.operators.moments import FAN_IN, _as_arrays
from fovea.session import ship_package

OVERSAMPLE, PASSES, TOLERANCE = 16, 12, 1e-6
#: Dimensions that travel together, and values multiplied at a time (32 MB as doubles).
CHUNK = 1024
BLOCK_VALUES = 4_000_000

PARTIAL = (
    "task bigint, chunk int, n bigint, mean array<double>, squares array<double>, "
    "centre array<double>, product array<double>"
)


@dataclass
class LowRank:
    """The first axes of a covariance, largest variance first.

    `axes` is width x rank; `residuals[i]` bounds the distance of `variances[i]` from a true variance;
    `total` is the variance of all dimensions, known exactly; `scale` divides the vectors before they are
    projected (1 where they were not standardized).
    """

    n: int
    mean: np.ndarray
    scale: np.ndarray
    variances: np.ndarray
    axes: np.ndarray
    residuals: np.ndarray
    total: float
    passes: int

    def select_k(self, threshold: float = 0.99) -> int:
        """The fewest axes that hold `threshold` of all variance; an error if those known do not."""
        totals = np.cumsum(self.variances) / self.total
        reaching = np.nonzero(totals >= threshold)[0]
        if not len(reaching):
            raise ValueError(f"{len(totals)} axes hold {totals[-1]:.4f} of the variance; ask for a higher rank")
        return int(reaching[0]) + 1

    def scree(self, spark: SparkSession) -> DataFrame:
        """(component from 1, variance, share, running total, residual as a share)."""
        shares = self.variances / self.total
        rows = zip(self.variances, shares, np.cumsum(shares), self.residuals / self.total)
        return spark.createDataFrame(
            [(i, *map(float, row)) for i, row in enumerate(rows, 1)],
            "component int, variance double, explained_variance double, cumulative double, residual double",
        )


class _State:
    """Count, mean, squares and centred product with a basis of a group of rows."""

    def __init__(self, basis: np.ndarray, scale: np.ndarray):
        self.basis, self.scale = basis, scale
        self.n, self.mean, self.squares, self.product = 0, None, None, None

    def add(self, rows: np.ndarray) -> None:
        first = rows[0].copy()
        rows = rows - first  # about its own first row, so that a constant dimension stays constant
        mean = rows.mean(axis=0)
        rows -= mean
        if (self.scale != 1).any():
            rows *= self.scale
            first, mean = first * self.scale, mean * self.scale
        self.merge(len(rows), first + mean, (rows * rows).sum(axis=0), rows.T @ (rows @ self.basis))

    def merge(self, n: int, mean: np.ndarray, squares: np.ndarray, product: np.ndarray) -> None:
        if not self.n:
            self.n, self.mean, self.squares, self.product = n, mean, squares, product
            return
        delta, share = mean - self.mean, self.n * n / (self.n + n)
        self.squares = self.squares + squares + share * delta * delta
        self.product = self.product + product + share * np.outer(delta, delta @ self.basis)
        self.mean = self.mean + delta * (n / (self.n + n))
        self.n += n


def _partials(arrays: DataFrame, basis: np.ndarray, scale: np.ndarray) -> DataFrame:
    shared = arrays.sparkSession.sparkContext.broadcast((basis, scale))  # width x basis numbers
    width = len(basis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _State(*shared.value)
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            if (sizes != width).any():
                raise ValueError(f"not every row has {width} dimensions")
            step = max(BLOCK_VALUES // max(width, 1), 1)
            for start in range(0, len(lists), step):
                flat = lists.slice(start, step).flatten().to_numpy(zero_copy_only=False)
                state.add(flat.reshape(-1, width).astype(np.float64))
        if not state.n:
            return
        centre = state.mean @ state.basis
        for chunk, low in enumerate(range(0, width, CHUNK)):
            part = slice(low, low + CHUNK)
            row = {
                "task": TaskContext.get().partitionId(), "chunk": chunk, "n": state.n,
                "mean": state.mean[part], "squares": state.squares[part], "centre": centre,
                "product": state.product[part].ravel(),
            }
            yield pa.RecordBatch.from_pylist([row], SCHEMA)

    return arrays.mapInArrow(run, PARTIAL)


_doubles = pa.list_(pa.float64())
SCHEMA = pa.schema(
    [("task", pa.int64()), ("chunk", pa.int32()), ("n", pa.int64())]
    + [(name, _doubles) for name in ("mean", "squares", "centre", "product")]
)


def _merge(table: pa.Table) -> pa.Table:
    """The rows of one chunk of dimensions as one row, in the order of tasks."""
    state = None
    for row in table.sort_by("task").to_batches():
        for i in range(row.num_rows):
            n = row.column("n")[i].as_py()
            mean, squares, centre, product = (
                row.column(name)[i].values.to_numpy() for name in ("mean", "squares", "centre", "product")
            )
            if state is None:
                state = n, mean, squares, centre, product.reshape(len(mean), -1)
                continue
            n0, mean0, squares0, centre0, product0 = state
            delta, share = mean - mean0, n0 * n / (n0 + n)
            part = n / (n0 + n)
            # the distance of the means along the basis needs all dimensions, and travels with each chunk
            cross = share * np.outer(delta, centre - centre0)
            state = (
                n0 + n, mean0 + delta * part, squares0 + squares + share * delta * delta,
                centre0 + (centre - centre0) * part, product0 + product.reshape(len(mean), -1) + cross,
            )
    n, mean, squares, centre, product = state
    row = {
        "task": table.column("task")[0].as_py() // FAN_IN, "chunk": table.column("chunk")[0].as_py(), "n": n,
        "mean": mean, "squares": squares, "centre": centre, "product": product.ravel(),
    }
    return pa.Table.from_pylist([row], SCHEMA)


def _pass(arrays: DataFrame, basis: np.ndarray, scale: np.ndarray) -> tuple:
    """(n, mean, variances of the dimensions, covariance times basis), of scaled rows."""
    partials = _partials(arrays, basis, scale)
    nearby = F.floor(F.col("task") / FAN_IN).alias("near")
    for keys in (("chunk", nearby), ("chunk",)):
        partials = partials.groupBy(*keys).applyInArrow(_merge, PARTIAL)
    rows = sorted(partials.collect(), key=lambda row: row["chunk"])  # width x basis numbers in all
    if not rows:
        raise ValueError("no rows to take principal axes of")
    n = rows[0]["n"]
    if n < 2:
        raise ValueError("a covariance needs at least two rows")
    mean = np.concatenate([row["mean"] for row in rows])
    squares = np.concatenate([row["squares"] for row in rows])
    product = np.concatenate([np.reshape(row["product"], (-1, basis.shape[1])) for row in rows])
    return n, mean, squares / (n - 1), product / (n - 1)


def principal_axes(
    df: DataFrame,
    column: str,
    rank: int,
    standardize: bool = False,
    oversample: int = OVERSAMPLE,
    passes: int = PASSES,
    tolerance: float = TOLERANCE,
    seed: int = 0,
) -> LowRank:
    """The first `rank` axes of an array or vector column without NULLs, all rows of one width.

    Reads `df` once per pass, and once more for the deviations with `standardize`; give it a staged
    table. At most `passes` passes are made; fewer, when every residual is below `tolerance` times the
    largest variance. Look at `residuals` where the variances fall off slowly.
    """
    ship_package(df.sparkSession)
    arrays = _as_arrays(df, column)
    first = arrays.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to take principal axes of")
    width = first["n"]
    scale = np.ones(width)
    if standardize:
        variances = _pass(arrays, np.zeros((width, 1)), scale)[2]
        np.divide(1.0, np.sqrt(variances), out=scale, where=variances > 0)
        scale[variances <= 0] = 0.0
    rank = min(rank, width)
    random = np.random.default_rng(seed).standard_normal((width, min(rank + oversample, width)))
    basis = np.linalg.qr(random)[0]
    for done in range(1, passes + 1):
        n, mean, variances, product = _pass(arrays, basis, scale)
        small = basis.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        axes = basis @ turn
        residuals = np.linalg.norm(product @ turn - axes * values, axis=0)
        if residuals[:rank].max() <= tolerance * max(values[0], 0.0) or done == passes:
            break
        basis = np.linalg.qr(product @ turn)[0]
    axes = axes[:, :rank]
    largest = (np.abs(axes) > 1e-9 * np.abs(axes).max(axis=0)).argmax(axis=0)
    axes = axes * np.where(axes[largest, np.arange(rank)] < 0, -1.0, 1.0)
    whole = float(variances.sum())
    if not whole > 0:
        raise ValueError("the vectors have no variance")
    return LowRank(n, mean, scale, np.clip(values[:rank], 0, None), axes, residuals[:rank], whole, done)


def project(
    df: DataFrame, fit: LowRank, column: str, output_col: str = "features_pca", k: int | None = None
) -> DataFrame:
    """`df` with its vectors on the first `k` axes, an array of doubles, not centred.

    A NULL vector stays NULL; a vector of another width is an error.
    """
    ship_package(df.sparkSession)
    matrix = fit.axes[:, : k or fit.axes.shape[1]] * fit.scale[:, None]
    shared = df.sparkSession.sparkContext.broadcast(matrix)  # width x k numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = shared.value
        width, k = matrix.shape
        for batch in batches:
            lists = batch.column("_x")
            out = []
            step = max(BLOCK_VALUES // width, 1)
            for start in range(0, len(lists), step):
                part = lists.slice(start, step)
                sizes = part.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
                if ((sizes != width) & (sizes >= 0)).any():
                    raise ValueError(f"not every row has {width} dimensions")
                flat = part.drop_null().flatten().to_numpy(zero_copy_only=False)
                rows = iter(flat.reshape(-1, width).astype(np.float64) @ matrix)
                out += [next(rows) if size >= 0 else None for size in sizes.tolist()]
            kept = [c for c in batch.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(out, _doubles)], [*kept, output_col]
            )

    kept = [name for name in df.columns if name != output_col]
    schema = df.select(*kept).schema.add(output_col, T.ArrayType(T.DoubleType()))
    vector = isinstance(df.schema[column].dataType, VectorUDT)
    values = vector_to_array(column) if vector else F.col(column)
    return df.select(*kept, values.alias("_x")).mapInArrow(run, schema)


def save_axes(fit: LowRank, spark: SparkSession, path: str) -> None:
    """Write a fit to two tables: its axes, and a row per dimension."""
    rows = zip(fit.variances, fit.residuals, fit.axes.T)
    axes = [(i, float(v), float(r), [float(x) for x in axis]) for i, (v, r, axis) in enumerate(rows)]
    spark.createDataFrame(axes, "axis int, variance double, residual double, loadings array<double>").write.parquet(
        f"{path}/axes"
    )
    whole = [(fit.n, fit.total, fit.passes, fit.mean.tolist(), fit.scale.tolist())]
    schema = "n bigint, total double, passes int, mean array<double>, scale array<double>"
    spark.createDataFrame(whole, schema).write.parquet(f"{path}/fit")


def load_axes(spark: SparkSession, path: str) -> LowRank:
    rows = spark.read.parquet(f"{path}/axes").orderBy("axis").collect()  # rank rows
    whole = spark.read.parquet(f"{path}/fit").first()
    return LowRank(
        whole["n"], np.array(whole["mean"]), np.array(whole["scale"]),
        np.array([row["variance"] for row in rows]), np.array([row["loadings"] for row in rows]).T,
        np.array([row["residual"] for row in rows]), whole["total"], whole["passes"],
    )
