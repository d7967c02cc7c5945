"""Principal axes without the covariance matrix, against the exact ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fovea.operators import low_rank


def sample(n: int, width: int, seed: int = 0) -> np.ndarray:
    """Correlated rows far from the origin whose variances fall off."""
    rng = np.random.default_rng(seed)
    mix = np.linalg.qr(rng.standard_normal((width, width)))[0] * (10 / (1 + np.arange(width)) ** 1.5)
    return rng.standard_normal((n, width)) @ mix.T + 1000.0 + 50 * rng.standard_normal(width)


def frame(spark, rows: np.ndarray, parts: int = 7):
    table = pa.table({"id": pa.array(range(len(rows))), "features": pa.array(list(rows))})
    return spark.createDataFrame(table).repartition(parts)


def exact(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, axes = np.linalg.eigh(np.cov(rows.T))
    axes = axes[:, ::-1]
    first = (np.abs(axes) > 1e-9 * np.abs(axes).max(axis=0)).argmax(axis=0)
    return values[::-1], axes * np.sign(axes[first, np.arange(len(values))])


@pytest.mark.parametrize("standardize", [False, True])
def test_axes_are_the_exact_ones(spark, standardize, monkeypatch):
    monkeypatch.setattr(low_rank, "CHUNK", 13)  # several chunks, the last one shorter
    monkeypatch.setattr(low_rank, "FAN_IN", 3)  # several levels of merging
    rows = sample(400, 60)
    rows[:, 7] = 3.5  # a constant dimension
    fit = low_rank.principal_axes(frame(spark, rows), "features", 5, standardize, tolerance=1e-10, passes=40)
    deviations = rows.std(axis=0, ddof=1)
    scale = np.divide(1.0, deviations, out=np.zeros(60), where=deviations > 1e-9) if standardize else np.ones(60)
    values, axes = exact(rows * scale)
    assert np.allclose(fit.variances, values[:5], rtol=1e-8)
    assert np.allclose(fit.total, values.sum()) and fit.n == 400
    assert np.allclose(fit.axes, axes[:, :5], atol=1e-5)
    assert np.allclose(fit.mean, (rows * scale).mean(axis=0))
    projected = low_rank.project(frame(spark, rows), fit, "features", k=3).orderBy("id").collect()
    assert np.allclose([r["features_pca"] for r in projected], (rows * scale) @ axes[:, :3], atol=1e-2)


def test_residuals_bound_the_error(spark):
    rows = np.random.default_rng(3).standard_normal((300, 40))  # nothing stands out
    fit = low_rank.principal_axes(frame(spark, rows), "features", 4, oversample=2, passes=2)
    values, _ = exact(rows)
    assert fit.passes == 2 and fit.residuals.max() > 1e-3
    for value, residual in zip(fit.variances, fit.residuals):
        assert np.abs(values - value).min() <= residual + 1e-12


def test_wide_vectors_take_no_square_matrix(spark):
    """Twenty thousand columns: the covariance would be 3.2 GB, and what is held here is 0.1 % of it."""
    width, n = 20_000, 96
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.standard_normal((width, 3)))[0]
    rows = rng.standard_normal((n, 3)) * [40, 20, 10] @ axes.T + 0.01 * rng.standard_normal((n, width))
    fit = low_rank.principal_axes(frame(spark, rows.astype(np.float32)), "features", 3, oversample=5)
    centred = rows - rows.mean(axis=0)
    values = np.linalg.svd(centred, compute_uv=False)[:3] ** 2 / (n - 1)
    assert np.allclose(fit.variances, values, rtol=1e-5)
    assert fit.axes.shape == (width, 3) and fit.passes < low_rank.PASSES
    assert fit.select_k(0.9) <= 3


def test_curve_choice_and_saving(spark, tmp_path):
    rows = sample(200, 20)
    df = frame(spark, rows).withColumn("features", array_to_vector("features"))  # vectors as well as arrays
    fit = low_rank.principal_axes(df, "features", 6, tolerance=1e-9, passes=30)
    values, _ = exact(rows)
    curve = fit.scree(spark).orderBy("component").collect()
    assert np.allclose([r["cumulative"] for r in curve], np.cumsum(values)[:6] / values.sum())
    k = int((np.cumsum(values) / values.sum() >= 0.9).argmax()) + 1
    assert fit.select_k(0.9) == k
    with pytest.raises(ValueError, match="higher rank"):
        fit.select_k(1.0)
    low_rank.save_axes(fit, spark, str(tmp_path / "fit"))
    again = low_rank.load_axes(spark, str(tmp_path / "fit"))
    ours, theirs = (low_rank.project(df, f, "features").orderBy("id").collect() for f in (fit, again))
    assert [r["features_pca"] for r in ours] == [r["features_pca"] for r in theirs]


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0]), (3, None)], "id int, features array<double>")
    usable = df.where("features is not null")
    fit = low_rank.principal_axes(usable, "features", 9)
    assert fit.axes.shape == (2, 2) and np.allclose(fit.variances, [4.0, 0.0])
    rows = low_rank.project(df, fit, "features").orderBy("id").collect()
    assert rows[2]["features_pca"] is None and len(rows[0]["features_pca"]) == 2
    with pytest.raises(ValueError, match="no rows"):
        low_rank.principal_axes(usable.limit(0), "features", 1)
    with pytest.raises(ValueError, match="no variance"):
        low_rank.principal_axes(spark.createDataFrame([([1.0],)] * 3, "features array<double>"), "features", 1)
    with pytest.raises(ValueError, match="two rows"):
        low_rank.principal_axes(usable.limit(1), "features", 1)
    ragged = usable.withColumn("features", F.when(F.col("id") == 1, F.array(F.lit(1.0))).otherwise(F.col("features")))
    with pytest.raises(Exception, match="not every row"):
        low_rank.principal_axes(ragged, "features", 1)
