from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from fixture_files import bmp, onnx_conv
from pyspark.sql import functions as F

from conftest import picture
from fovea.functions.paths import plain_path
from fovea.operators import backends
from fovea.operators.featurize import (
    ARROW_ROWS,
    featurize,
    pooling_report,
    set_batch_rows,
    split_rejects,
)
from fovea.operators.images import bgr_minus_mean_batch, decode_bitmap
from fovea.operators.images import file_stack, image_stack, tensor_stack
from fovea.session import stage
from fovea.sources.files import read_images


@pytest.fixture(scope="module")
def tensor_rows(spark):
    values = np.random.default_rng(0).normal(size=(500, 12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, t array<float>").repartition(5), values


def features(df):
    return {r["id"]: r["features"] for r in df.collect()}


def test_linear_model(spark, tensor_rows):
    df, values = tensor_rows
    weights = np.random.default_rng(1).normal(size=(12, 5)).astype(np.float32)
    out = featurize(df, backends.linear_model(spark, weights), tensor_stack((12,)), "t", ["id"])
    assert out.schema["features"].dataType.simpleString() == "array<float>"
    found = features(out)
    expected = np.maximum(values @ weights, 0)
    assert np.allclose([found[i] for i in range(500)], expected, atol=1e-5)


@pytest.mark.parametrize("batch_rows, arrow_rows", [(1, 7), (3, 1000), (1024, 1), (64, 64)])
def test_result_does_not_depend_on_batches_or_partitions(spark, tensor_rows, batch_rows, arrow_rows):
    df, values = tensor_rows
    before = spark.conf.get(ARROW_ROWS)
    set_batch_rows(spark, arrow_rows)
    try:
        out = featurize(
            df,
            backends.pooling_model("max"),
            tensor_stack((2, 2, 3)),
            "t",
            ["id"],
            batch_rows=batch_rows,
            partitions=3,
            partition_key="id",
        )
        assert out.rdd.getNumPartitions() == 3
        found = features(out)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    expected = values.reshape(500, 4, 3).max(axis=1)
    assert (np.array([found[i] for i in range(500)], np.float32) == expected).all()


def test_featurize_leaves_the_session_as_it_is(spark, sf_dir):
    from fovea.plans.catalogue import QUERIES

    before = spark.conf.get(ARROW_ROWS)
    spread = sorted(QUERIES["featurize_spread"](spark, sf_dir).collect())
    assert spark.conf.get(ARROW_ROWS) == before
    assert sorted(QUERIES["featurize_linear"](spark, sf_dir).collect()) == spread
    assert spark.conf.get(ARROW_ROWS) == before


def test_kept_models_are_bounded(monkeypatch):
    from fovea.operators import featurize as module

    monkeypatch.setattr(module, "_worker_models", {})
    loads = []
    for key in "abcd" "abcd" "e" "bcde" "a":
        module._load_once(key, lambda key=key: loads.append(key) or key)
    assert loads == ["a", "b", "c", "d", "e", "a"] and len(module._worker_models) == 4


def test_outputs_of_any_rank_are_flattened(spark, tensor_rows):
    df, values = tensor_rows
    out = featurize(df, lambda: lambda batch: batch * 2, tensor_stack((2, 2, 3)), "t", ["id"])
    found = features(out)
    assert (np.array([found[i] for i in range(500)], np.float32) == values * 2).all()


def test_rejected_rows_keep_their_reason(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0]), (3, [3.0, 4.0]), (4, [1.0, None])]
    df = spark.createDataFrame(rows, "id int, t array<float>").coalesce(1)
    out = featurize(df, lambda: lambda batch: batch, tensor_stack((2,)), "t", ["id"])
    good, bad = split_rejects(out)
    assert features(good) == {0: [1.0, 2.0], 3: [3.0, 4.0]}
    assert {r["id"]: r["reject_reason"] for r in bad.collect()} == {
        1: "missing", 2: "wrong width", 4: "not finite"
    }
    assert bad.where("features is not null").count() == 0


def test_all_rows_rejected(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, None)], "id int, t array<float>").coalesce(1)
    out = featurize(df, lambda: lambda batch: batch, tensor_stack((2,)), "t", ["id"])
    assert {r["reject_reason"] for r in out.collect()} == {"missing", "wrong width"}


def test_model_sees_every_row_once_and_loads_once_per_worker(spark, tensor_rows):
    df, _ = tensor_rows
    rows, loads = (spark.sparkContext.accumulator(0) for _ in range(2))

    def factory():
        loads.add(1)

        def predict(batch):
            rows.add(len(batch))
            return batch

        return predict

    out = featurize(df, factory, tensor_stack((12,)), "t", ["id"], batch_rows=10)
    staged = stage(out.withColumn("n", F.size("features")).where("n > 0"), "features")
    staged.count()
    staged.where("reject_reason is null").agg(F.sum("n")).collect()
    assert rows.value == 500
    assert 1 <= loads.value <= 8


def test_udf_runs_once_in_the_plan(spark, tensor_rows):
    df, _ = tensor_rows
    out = featurize(df, lambda: lambda b: b, tensor_stack((12,)), "t", ["id"])
    good = split_rejects(out.withColumn("reject_reason", F.coalesce("reject_reason", F.lit(None))))[0]
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("pythonUDF1") == 0


def test_filters_on_results_do_not_run_the_model_again(spark, tensor_rows):
    df, _ = tensor_rows
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def predict(batch):
            seen.add(len(batch))
            return batch

        return predict

    out = featurize(df.where("id < 40"), factory, tensor_stack((12,)), "t", ["id"])
    good, _ = split_rejects(out)
    good.where(F.size("features") == 12).agg(F.sum(F.size("features"))).collect()
    assert seen.value == 40


def conv_reference(batch, weights):
    windows = np.lib.stride_tricks.sliding_window_view(batch, (3, 3), axis=(1, 2))
    return np.maximum(np.einsum("nhwcij,ocij->nhwo", windows, weights), 0)


@pytest.mark.parametrize("pooling", ["max", "avg"])
def test_onnx_model_on_decoded_images(spark, image_root, tmp_path, pooling):
    weights = np.random.default_rng(2).normal(0, 0.1, (6, 3, 3, 3)).astype(np.float32)
    path = tmp_path / f"conv-{pooling}.onnx"
    path.write_bytes(onnx_conv(weights, 100, 100))
    images = read_images(spark, image_root + "/Apple Red")
    df = images.select(plain_path("image.origin").alias("id"), "image")
    out = featurize(
        df,
        backends.onnx_model(spark, str(path), pooling=pooling),
        image_stack((100, 100, 3)),
        "image",
        ["id"],
    )
    found = {key.rsplit("/", 1)[1]: value for key, value in features(out).items()}
    batch = bgr_minus_mean_batch(np.stack([picture(i) for i in range(6)]))
    maps = conv_reference(batch, weights)
    expected = maps.max(axis=(1, 2)) if pooling == "max" else maps.mean(axis=(1, 2))
    assert np.allclose([found[f"{i}.png"] for i in range(6)], expected, rtol=1e-3)


def test_files_and_decoded_images_give_the_same_features(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for i in range(12):
        (tmp_path / "c" / f"{i}.bmp").write_bytes(bmp(picture(i, 20, 30)))
    model = backends.not_pretrained_conv(16)
    raw = spark.read.format("binaryFile").load(str(tmp_path / "c"))
    from_files = featurize(
        raw.withColumnRenamed("path", "id"),
        model, file_stack(decode_bitmap, (20, 30, 3)), "content", ["id"],
    )
    decoded = read_images(spark, str(tmp_path / "c"))
    from_images = featurize(
        decoded.select(plain_path("image.origin").alias("id"), "image"),
        model, image_stack((20, 30, 3)), "image", ["id"],
    )
    a, b = features(from_files), features(from_images)
    assert a.keys() == b.keys() and len(a) == 12
    assert all(np.allclose(a[key], b[key], atol=1e-4) for key in a)


@pytest.mark.parametrize("pooling, width", [("max", 512), ("avg", 512), (None, 25 * 25 * 512)])
def test_not_pretrained_conv_shapes(pooling, width):
    batch = np.stack([picture(1), picture(2)]).astype(np.float32)
    model = backends.not_pretrained_conv(pooling=pooling)()
    output = model(batch).reshape(2, -1)
    assert output.shape == (2, width)
    assert (output == backends.not_pretrained_conv(pooling=pooling)()(batch).reshape(2, -1)).all()


def test_weights_too_large_to_broadcast(spark):
    with pytest.raises(ValueError, match="too large"):
        backends.linear_model(spark, np.zeros((10, 10)), max_broadcast_bytes=100)


def test_pooling_report_shows_that_averages_smooth(spark, tensor_rows):
    df, values = tensor_rows
    rows = {r["pooling"]: r for r in pooling_report(df, "t", 3).collect()}
    maps = values.astype(np.float64).reshape(500, 4, 3)
    for how, pooled in (("max", maps.max(axis=1)), ("avg", maps.mean(axis=1))):
        row = rows[how]
        assert np.allclose(
            [row["mean"], row["stddev"], row["min"], row["max"], row["mean_dim_stddev"]],
            [pooled.mean(), pooled.std(ddof=1), pooled.min(), pooled.max(),
             pooled.std(axis=0, ddof=1).mean()],
        )
    assert rows["avg"]["mean_dim_stddev"] < rows["max"]["mean_dim_stddev"]


def test_batches_are_bounded_by_bytes(spark):
    """Records of 1 KB and of 5 MB: no batch is decoded that is larger than 6 MB, unless by one record alone."""
    from fovea.operators import featurize as module

    sizes = np.array([3, 5, 9, 0, 1, 1, 1, 20])
    assert list(module.batch_bounds(sizes, 3, 10)) == [(0, 2), (2, 5), (5, 7), (7, 8)]
    assert list(module.batch_bounds(sizes[:0], 3, 10)) == []

    def stack(batch):
        total = sum(len(x) for x in batch.to_pylist() if x is not None)
        return np.full((len(batch), 2), [total, len(batch)], np.float64), [None] * len(batch)

    rows = spark.range(200, numPartitions=2).select(
        "id",
        F.when(F.col("id") % 40 == 7, F.expr("cast(repeat('x', 5 << 20) as binary)"))
        .when(F.col("id") == 3, F.lit(None).cast("binary"))
        .when(F.col("id") == 150, F.expr("cast(repeat('y', 20 << 20) as binary)"))
        .otherwise(F.expr("cast(repeat('z', 1024) as binary)")).alias("content"),
    )
    found = module.featurize(rows, lambda: lambda t: t, stack, "content", ["id"], batch_bytes=6 << 20).collect()
    assert len(found) == 200
    for row in found:
        total, together = row["features"]
        assert total <= 6 << 20 or (row["id"], total, together) == (150, 20 << 20, 1)
    assert max(row["features"][1] for row in found) > 10


def test_session_bounds_what_is_sent(spark):
    from fovea.operators import featurize as module

    before = spark.conf.get(module.ARROW_BYTES)
    assert before in ("64m", str(64 << 20))
    try:
        module.set_batch_bytes(spark, 1 << 20)
        rows = spark.range(64, numPartitions=1).select(F.expr("cast(repeat('x', 256 << 10) as binary)").alias("content"))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

        assert max(row["n"] for row in rows.mapInArrow(sizes, "n bigint").collect()) < 2 << 20
    finally:
        module.set_batch_bytes(spark, 64 << 20)


def test_quantiles_of_poolings(spark):
    from fovea.operators.featurize import pooling_quantiles

    rng = np.random.default_rng(1)
    tensors = rng.standard_normal((501, 12))
    df = spark.createDataFrame([(t.tolist(),) for t in tensors], "t array<double>").repartition(5)
    found = pooling_quantiles(df, "t", 3, (0.1, 0.5)).collect()
    assert len(found) == 2 * 3 * 2
    for row in found:
        values = getattr(tensors.reshape(501, 4, 3), {"max": "max", "avg": "mean"}[row["pooling"]])(axis=1)
        values = np.sort(values[:, row["dim"]])
        assert np.isclose(row["value"], values[int(np.ceil(row["quantile"] * 501)) - 1])
    assert pooling_quantiles(df.limit(0), "t", 3).count() == 0
