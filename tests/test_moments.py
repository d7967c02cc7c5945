from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fovea.operators import moments as m
from fovea.operators import reduce
from test_reduce import frame, matrix


def both(spark, values, partitions=4):
    df = frame(spark, values, partitions)
    return m.feature_moments(df, "features"), m.feature_moments(df, "vectors")


@pytest.mark.parametrize("partitions", [1, 7, 40])
@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_moments(spark, partitions, shift):
    values = np.random.default_rng(5).normal(size=(230, 6)) * np.logspace(-2, 2, 6) + shift
    for found in both(spark, values, partitions):
        assert found.n == 230
        assert np.allclose(found.mean, values.mean(axis=0))
        assert np.allclose(found.covariance, np.cov(values.T), rtol=1e-8, atol=1e-9)


def test_constant_dimension_is_exactly_constant(spark):
    values = np.random.default_rng(6).normal(size=(50, 3))
    values[:, 1] = 0.1
    for found in both(spark, values):
        assert found.covariance[1, 1] == 0 and found.mean[1] == 0.1
        assert (found.standardized_covariance()[1] == 0).all()
    table = m.stand_in(found, spark)
    scaled = reduce.fit_scaler(table).transform(table).select(vector_to_array("vectors_std"))
    assert {row[0][1] for row in scaled.collect()} == {0.0}


def test_an_outlier_first_row_does_not_spoil_the_sums(spark):
    values = np.random.default_rng(7).normal(size=(2000, 3))
    values[0] = 1e7
    df = frame(spark, values, 1)
    found = m.feature_moments(df.orderBy("id"), "features")
    assert np.allclose(found.covariance, np.cov(values.T))


@pytest.mark.parametrize("fan_in", [1, 2, 3, 64])
def test_merging_in_groups_gives_the_same(spark, monkeypatch, fan_in):
    monkeypatch.setattr(m, "FAN_IN", fan_in)
    values = np.random.default_rng(8).normal(size=(300, 4))
    found = m.feature_moments(frame(spark, values, 20), "features")
    assert found.n == 300 and np.allclose(found.covariance, np.cov(values.T))


def test_wide_vectors_take_the_same_way(spark):
    values = np.random.default_rng(14).normal(size=(12, 2100))
    df = frame(spark, values, 3)
    expected = np.cov(values.T)
    known = m.feature_moments(df, "features")
    assert np.allclose(known.covariance, expected)
    raw, _ = reduce.scree_pair(df, moments=known)
    assert raw.count() == 2100
    fitted = reduce.fit_reduction(df, output_col="r", standardize=False, moments=known, threshold=0.5)
    projected = matrix(fitted.model.transform(df), "r")
    assert projected.shape == (12, fitted.k) and fitted.k < 11
    assert np.allclose(projected.var(axis=0, ddof=1).sum(), known.principal_axes()[0][::-1][: fitted.k].sum())
    cells = reduce.covariance_table(df, "features").where("i = 2099 or j = 7").collect()
    assert len(cells) == 4199
    assert all(np.isclose(r["covariance"], expected[r["i"], r["j"]]) for r in cells)


@pytest.mark.parametrize("block", [1, 10, 17])
def test_block_size_does_not_matter(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK_VALUES", block)
    values = np.random.default_rng(12).normal(size=(60, 4))
    found = m.feature_moments(frame(spark, values, 2), "features")
    assert found.n == 60 and np.allclose(found.covariance, np.cov(values.T))


def test_float_arrays(spark):
    values = np.random.default_rng(9).normal(size=(90, 5)).astype(np.float32)
    df = frame(spark, values).select(F.col("features").cast("array<float>").alias("f"))
    assert np.allclose(m.feature_moments(df, "f").covariance, np.cov(values.astype(float).T))


def test_moments_refuse(spark):
    with pytest.raises(ValueError, match="no rows"):
        m.feature_moments(frame(spark, [[1.0]]).limit(0), "features")
    with pytest.raises(ValueError, match="at least two"):
        m.feature_moments(frame(spark, [[1.0, 2.0]]), "features")
    rows = [([1.0, 2.0],)] * 100 + [([1.0],), ([1.0, 2.0, 3.0],)]
    ragged = spark.createDataFrame(rows, "f array<double>").coalesce(1)
    with pytest.raises(Exception, match="not every row has 2"):
        m.feature_moments(ragged, "f")
    apart = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "f array<double>").repartition(2)
    with pytest.raises(Exception, match="dimensions"):
        m.feature_moments(apart, "f")


def test_stand_in_has_the_moments(spark):
    values = np.random.default_rng(10).normal(size=(40, 12)) @ np.diag(np.logspace(-2, 3, 12)) + 5
    found, _ = both(spark, values)
    points = np.array([row[0] for row in m.stand_in(found, spark).select(vector_to_array("vectors")).collect()])
    assert points.shape == (24, 12)
    assert np.allclose(points.mean(axis=0), values.mean(axis=0))
    assert np.allclose(np.cov(points.T), np.cov(values.T))


@pytest.mark.parametrize("standardize", [False, True])
@pytest.mark.parametrize("with_mean", [False, True])
def test_fit_on_the_stand_in_is_the_fit_on_the_data(spark, standardize, with_mean):
    values = np.random.default_rng(11).normal(size=(400, 8)) @ np.diag(np.linspace(1, 4, 8)) + 3
    df = frame(spark, values)
    options = {"output_col": "r", "standardize": standardize, "with_mean": with_mean, "threshold": 0.8}
    short = reduce.fit_reduction(df, features_col="features", **options)
    data, column = df, "vectors"
    if standardize or with_mean:
        scaler = reduce.fit_scaler(df, with_mean=with_mean, with_std=standardize)
        data, column = scaler.transform(df), "vectors_std"
    pca = reduce.fit_pca(data, column, "full")
    assert short.k == reduce.select_k(reduce.scree(pca, spark), 0.8) < 8
    direct = reduce.truncate_pca(pca, short.k, "r").transform(data)
    assert np.allclose(matrix(short.model.transform(df), "r"), matrix(direct, "r"))


def test_a_fit_decomposes_each_matrix_once(spark, monkeypatch):
    values = np.random.default_rng(15).normal(size=(100, 5))
    known = m.feature_moments(frame(spark, values), "features")
    calls, original = [], np.linalg.eigh
    monkeypatch.setattr(np.linalg, "eigh", lambda x: calls.append(len(x)) or original(x))
    for _ in range(2):
        reduce.fit_reduction(frame(spark, values), output_col="r", moments=known, threshold=0.8)
    assert calls == [5]


def test_known_moments_need_no_pass(spark, monkeypatch):
    values = np.random.default_rng(13).normal(size=(200, 6)) @ np.diag(np.linspace(1, 9, 6))
    df = frame(spark, values)
    known = m.feature_moments(df, "features")
    separate = [reduce.fit_reduction(df, output_col="r", standardize=s, threshold=0.8) for s in (False, True)]

    def refuse(*_):
        raise AssertionError("a pass over the data")

    monkeypatch.setattr(reduce, "feature_moments", refuse)
    raw, std = reduce.scree_pair(df, moments=known)
    for apart, standardize, curve in zip(separate, (False, True), (raw, std)):
        shared = reduce.fit_reduction(
            df, output_col="r", standardize=standardize, threshold=0.8, moments=known
        )
        assert shared.k == apart.k == reduce.select_k(curve, 0.8)
        assert np.allclose(matrix(shared.model.transform(df), "r"), matrix(apart.model.transform(df), "r"))


def test_one_pass_over_the_features_only(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    seen = []
    original = m._as_arrays

    def spy(df, column):
        seen.append(original(df, column))
        return seen[-1]

    m._as_arrays, restore = spy, original
    try:
        reduce.fit_reduction(
            reduce.with_vectors(embeddings, "embedding"), output_col="r", features_col="embedding"
        )
    finally:
        m._as_arrays = restore
    assert len(seen) == 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<embedding:array<float>>" in plan
