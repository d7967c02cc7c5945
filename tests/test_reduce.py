from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fovea.operators import reduce
from fovea.plans import catalogue
from fovea.plans.feature_table import reduce_features


def frame(spark, values, partitions=4):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, features array<double>").repartition(partitions)
    return reduce.with_vectors(df)


def matrix(df, column):
    rows = df.select("id", vector_to_array(column).alias("v")).orderBy("id").collect()
    return np.array([r["v"] for r in rows])


def shares(table):
    return np.array([r["explained_variance"] for r in table.orderBy("component").collect()])


def totals(table):
    return np.array([r["cumulative"] for r in table.orderBy("component").collect()])


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(10, 10)) * np.linspace(0.1, 5, 10)
    return rng.normal(size=(300, 10)) @ mixing + rng.normal(size=10) * 10


def eigen_shares(covariance):
    values = np.linalg.eigvalsh(covariance)[::-1]
    return values / values.sum()


def test_scaler_divides_by_sample_deviation_without_centring(spark, sample):
    df = frame(spark, sample)
    model = reduce.fit_scaler(df)
    expected = sample / sample.std(axis=0, ddof=1)
    assert np.allclose(matrix(model.transform(df), "vectors_std"), expected)
    stats = reduce.scaler_stats(model, spark).orderBy("dim").collect()
    assert np.allclose([r["std"] for r in stats], sample.std(axis=0, ddof=1))
    assert np.allclose([r["mean"] for r in stats], sample.mean(axis=0))


def test_scaler_with_mean(spark, sample):
    df = frame(spark, sample)
    found = matrix(reduce.fit_scaler(df, with_mean=True).transform(df), "vectors_std")
    assert np.allclose(found, (sample - sample.mean(axis=0)) / sample.std(axis=0, ddof=1))


def test_constant_dimension_becomes_zero(spark):
    df = frame(spark, [[1, 2], [1, 4]])
    found = matrix(reduce.fit_scaler(df).transform(df), "vectors_std")
    assert np.allclose(found, [[0, 2 / np.sqrt(2)], [0, 4 / np.sqrt(2)]], atol=1e-4)


def test_explained_variance(spark, sample):
    df = frame(spark, sample)
    raw = reduce.scree(reduce.fit_pca(df), spark)
    assert np.allclose(shares(raw), eigen_shares(np.cov(sample.T)))
    found = totals(raw)
    assert (np.diff(found) >= 0).all() and found[-1] == pytest.approx(1)


def test_scree_pair_is_that_of_two_fits(spark, sample):
    df = frame(spark, sample)
    raw, std = reduce.scree_pair(df)
    assert np.allclose(shares(raw), shares(reduce.scree(reduce.fit_pca(df), spark)))
    scaled = reduce.fit_scaler(df).transform(df)
    assert np.allclose(
        shares(std), shares(reduce.scree(reduce.fit_pca(scaled, "vectors_std"), spark))
    )
    joined = reduce.compare_scree(raw, std).orderBy("component").collect()
    assert np.allclose([r["delta"] for r in joined], totals(std) - totals(raw))


def test_scree_pair_with_constant_dimensions(spark, sample):
    values = np.hstack([sample[:, :3], np.full((300, 1), 7.0)])
    raw, std = reduce.scree_pair(frame(spark, values))
    assert np.allclose(shares(std)[:3], eigen_shares(np.corrcoef(sample[:, :3].T)))
    assert abs(shares(std)[3]) < 1e-12 and abs(shares(raw)[3]) < 1e-12
    with pytest.raises(ValueError, match="no variance"):
        reduce.scree_pair(frame(spark, [[1, 1], [1, 1]]))


def test_covariance(spark, sample):
    rows = reduce.covariance_table(frame(spark, sample)).collect()
    found = np.zeros((10, 10))
    for r in rows:
        found[r["i"], r["j"]] = r["covariance"]
    assert np.allclose(found, np.cov(sample.T))


def test_width_comes_from_metadata_or_one_row(spark, sample):
    df = frame(spark, sample)
    assert reduce.vector_width(df, "vectors") == 10
    scaled = reduce.fit_scaler(df).transform(df)
    assert scaled.schema["vectors_std"].metadata["ml_attr"]["num_attrs"] == 10
    with pytest.raises(ValueError, match="no rows"):
        reduce.vector_width(df.limit(0), "vectors")


def test_projection_is_not_centred(spark, sample):
    df = frame(spark, sample)
    model = reduce.fit_pca(df)
    assert np.allclose(matrix(model.transform(df), "pca"), sample @ model.pc.toArray())


@pytest.mark.parametrize("standardize", [False, True])
def test_truncation_equals_second_fit(spark, sample, standardize):
    df = frame(spark, sample)
    fitted = reduce.fit_reduction(df, output_col="r", standardize=standardize, threshold=0.9)
    assert 1 <= fitted.k < 10
    found = matrix(fitted.model.transform(df), "r")
    source, column = df, "vectors"
    if standardize:
        source, column = reduce.fit_scaler(df).transform(df), "vectors_std"
    again = reduce.fit_pca(source, column, "again", k=fitted.k)
    expected = matrix(again.transform(source), "again") * reduce.component_signs(again)
    assert found.shape == (300, fitted.k)
    assert np.allclose(found, expected)


def test_projected_covariance_is_diagonal_and_matches_the_scree(spark, sample):
    df = frame(spark, sample)
    fitted = reduce.fit_reduction(df, output_col="r", threshold=2.0, if_never="all")
    covariance = np.cov(matrix(fitted.model.transform(df), "r").T)
    assert np.allclose(covariance, np.diag(np.diag(covariance)), atol=1e-8)
    assert np.allclose(np.diag(covariance) / covariance.trace(), shares(fitted.scree))


def test_signs_make_the_first_loading_positive(spark, sample):
    model = reduce.fit_pca(frame(spark, sample))
    loadings = model.pc.toArray() * reduce.component_signs(model)
    assert (loadings[0] > 0).all()


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_result_does_not_depend_on_partitions(spark, sample, partitions):
    fitted = reduce.fit_reduction(frame(spark, sample), output_col="r", threshold=0.9)
    df = frame(spark, sample, partitions)
    other = reduce.fit_reduction(df, output_col="r", threshold=0.9)
    assert other.k == fitted.k
    assert np.allclose(matrix(other.model.transform(df), "r"), matrix(fitted.model.transform(df), "r"))


def test_select_k(spark):
    table = reduce._scree_table(np.array([0.6, 0.3, 0.09, 0.01]), spark)
    assert [reduce.select_k(table, t) for t in (0.5, 0.6, 0.61, 0.89, 0.95)] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError, match="never reach"):
        reduce.select_k(table, 1.5)
    assert reduce.select_k(table, 1.5, if_never="all") == 4
    row = reduce.first_reaching(table, 1.5).first()
    assert row["k"] is None and row["reached"] is None
    zoomed = reduce.scree_zoom(table, 0.95, last=3).orderBy("component").collect()
    assert [r["above_threshold"] for r in zoomed] == [False, False, True]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.floats(0.001, 1), min_size=1, max_size=30),
    st.floats(0.01, 0.98),
    st.floats(0, 0.01),
)
def test_k_grows_with_the_threshold(spark, weights, threshold, step):
    values = np.sort(np.array(weights))[::-1]
    table = reduce._scree_table(values / values.sum(), spark)
    low, high = reduce.select_k(table, threshold), reduce.select_k(table, threshold + step)
    running = totals(table)
    assert low <= high
    assert running[low - 1] >= threshold and (low == 1 or running[low - 2] < threshold)


def test_fewer_rows_than_dimensions(spark):
    values = np.random.default_rng(4).normal(size=(10, 64))
    found = shares(reduce.scree(reduce.fit_pca(frame(spark, values)), spark))
    assert len(found) == 64 and (np.abs(found[9:]) < 1e-9).all() and found[8] > 1e-6


def test_fit_refuses(spark, sample, monkeypatch):
    df = frame(spark, sample)
    with pytest.raises(Exception):
        reduce.fit_pca(df, k=11)
    with pytest.raises(Exception):
        reduce.fit_pca(frame(spark, [[1, 2]]))
    monkeypatch.setattr(reduce, "MAX_WIDTH", 5)
    with pytest.raises(ValueError, match="at most"):
        reduce.fit_pca(df)


def test_null_features_are_no_silent_loss(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "id int, features array<double>")
    with pytest.raises(Exception, match="features is NULL"):
        reduce.with_vectors(df).collect()
    usable, rejects = reduce.split_features(df)
    assert [r["id"] for r in usable.collect()] == [1]
    assert [(r["id"], r["reject_reason"]) for r in rejects.collect()] == [(2, "missing")]


def test_unusable_features_are_rejected_with_reasons(spark, sample):
    odd = [(1000, None), (1001, [1.0]), (1002, [float("nan")] * 10), (1003, [1.0] * 9 + [None])]
    rows = frame(spark, sample).drop("vectors").unionByName(
        spark.createDataFrame(odd, "id int, features array<double>")
    )
    table, rejects, fitted = reduce_features(rows, ["id"], width=10, threshold=0.9)
    assert table.count() == 300
    assert {r["id"]: r["reject_reason"] for r in rejects.collect()} == {
        1000: "missing", 1001: "wrong width", 1002: "not finite", 1003: "not finite",
    }
    clean, _, again = reduce_features(frame(spark, sample).drop("vectors"), ["id"], threshold=0.9)
    assert np.allclose(matrix(table, "features_std_pca"), matrix(clean, "features_std_pca"))


def test_width_is_the_most_frequent_one(spark):
    rows = [(0, [1.0, 2.0])] + [(k, [float(k), 2.0, 3.0]) for k in range(1, 5)] + [(k, []) for k in range(5, 15)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id int, features array<double>").coalesce(1)
        usable, rejects = reduce.split_features(df)
        assert {r["id"] for r in usable.collect()} == {1, 2, 3, 4}
        assert {r["id"] for r in rejects.collect()} == {0, *range(5, 15)}


@pytest.mark.parametrize("name", ["feature_table", "feature_table_ends", "pca_norms"])
def test_queries_report_rejects(spark, sf_dir, tmp_path, name):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").limit(200).coalesce(1)
    ragged = F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 5)).otherwise(F.col("embedding"))
    embeddings.withColumn("embedding", ragged).write.parquet(f"{tmp_path}/embeddings.parquet")
    odd = embeddings.where("vec_id % 50 = 0").count()
    with pytest.warns(UserWarning, match=f"rows rejected: {odd} wrong width"):
        found = catalogue.QUERIES[name](spark, str(tmp_path))
    assert found.select("vec_id").distinct().count() == 200 - odd > 0


def test_model_survives_saving(spark, sample, tmp_path):
    df = frame(spark, sample)
    fitted = reduce.fit_reduction(df, output_col="r", threshold=0.9)
    path = str(tmp_path / "model")
    fitted.model.write().save(path)
    again = PipelineModel.load(path)
    assert np.array_equal(matrix(again.transform(df), "r"), matrix(fitted.model.transform(df), "r"))


def test_reduce_features_keeps_columns(spark, sample):
    df = frame(spark, sample).drop("vectors").withColumn("class", F.lit("x"))
    table, rejects, fitted = reduce_features(df, ["id", "class"], threshold=0.9)
    assert rejects.columns == ["id", "class", "reject_reason"] and rejects.count() == 0
    assert table.columns == ["id", "class", "features_std_pca"]
    assert matrix(table, "features_std_pca").shape == (300, fitted.k)
