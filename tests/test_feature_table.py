"""The whole way from image files to a labelled table, in batch and as a stream."""

from __future__ import annotations

import numpy as np
import pytest
from fixture_files import bmp
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import picture
from fovea.functions.paths import class_from_path
from fovea.operators.backends import not_pretrained_conv
from fovea.operators.featurize import featurize
from fovea.operators.images import bgr_minus_mean_batch, decode_bitmap, file_stack, image_stack
from fovea.operators.reduce import with_vectors
from fovea.plans.feature_table import build_feature_table
from fovea.sources import files, sinks
from fovea.streaming.scoring import score_stream, stream_binary

SHAPE = (20, 20, 3)


@pytest.fixture(scope="module")
def bitmaps(tmp_path_factory):
    root = tmp_path_factory.mktemp("bitmaps")
    for name, start in (("Apple Red", 0), ("Plum", 40)):
        (root / name).mkdir()
        for i in range(start, start + 40):
            (root / name / f"{i}.bmp").write_bytes(bmp(picture(i, 20, 20)))
    (root / "Plum" / "broken.bmp").write_bytes(b"BM")
    (root / "Plum" / "wide.bmp").write_bytes(bmp(picture(99, 20, 21)))
    return str(root)


def reference_table(threshold):
    batch = bgr_minus_mean_batch(np.stack([picture(i, 20, 20) for i in range(80)]))
    features = not_pretrained_conv(8)()(batch).astype(np.float64)
    scaled = features / features.std(axis=0, ddof=1)
    values, loadings = np.linalg.eigh(np.cov(scaled.T))
    values, loadings = values[::-1], loadings[:, ::-1]
    k = int(np.argmax(np.cumsum(values) / values.sum() >= threshold)) + 1
    loadings = loadings * np.where(loadings[0] < 0, -1, 1)
    return k, (scaled @ loadings)[:, :k]


def build(spark, bitmaps, calls=None, **options):
    inner = not_pretrained_conv(8)

    def factory():
        model = inner()

        def predict(batch):
            if calls is not None:
                calls.add(len(batch))
            return model(batch)

        return predict

    return build_feature_table(
        files.read_class_tree(spark, bitmaps),
        factory,
        file_stack(decode_bitmap, SHAPE),
        width=8,
        reduction={"threshold": 0.9},
        **options,
    )


def test_feature_table(spark, bitmaps, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    table, rejects, fitted = build(spark, bitmaps, calls)
    assert table.columns == ["path", "features_std_pca", "class"]
    out = str(tmp_path / "features")
    sinks.write_table(table, out)
    written = spark.read.parquet(out)
    rows = written.select(
        F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("int").alias("n"),
        "class",
        vector_to_array("features_std_pca").alias("v"),
    ).orderBy("n").collect()
    k, expected = reference_table(0.9)
    assert fitted.k == k
    assert [r["class"] for r in rows] == ["Apple Red"] * 40 + ["Plum"] * 40
    assert np.allclose([r["v"] for r in rows], expected, atol=1e-4)
    assert {r["path"].rsplit("/", 1)[1]: r["reject_reason"] for r in rejects.collect()} == {
        "broken.bmp": "not an image",
        "wide.bmp": "wrong size",
    }
    # one model run per usable file, though scaler, PCA, rejects and the write all read the result
    assert calls.value == 80


def test_feature_width_is_checked(spark, bitmaps):
    with pytest.raises(Exception):
        build_feature_table(
            files.read_class_tree(spark, bitmaps),
            not_pretrained_conv(8),
            file_stack(decode_bitmap, SHAPE),
            width=9,
        )


def test_decoded_images_give_the_same_table(spark, bitmaps):
    table, _, fitted = build(spark, bitmaps)
    images = files.read_image_tree(spark, bitmaps)
    other, rejects, again = build_feature_table(
        images,
        not_pretrained_conv(8),
        image_stack(SHAPE),
        width=8,
        input_col="image",
        reduction={"threshold": 0.9},
    )
    assert again.k == fitted.k and rejects.count() == 2
    joined = table.alias("a").join(other.alias("b"), "path").select(
        vector_to_array("a.features_std_pca").alias("x"),
        vector_to_array("b.features_std_pca").alias("y"),
    ).collect()
    assert len(joined) == 80
    assert np.allclose([r["x"] for r in joined], [r["y"] for r in joined], atol=1e-4)


def test_stream_scores_files_as_they_arrive(spark, bitmaps, tmp_path):
    table, _, fitted = build(spark, bitmaps)
    incoming = tmp_path / "incoming"
    (incoming / "Apple Red").mkdir(parents=True)
    out, checkpoint = str(tmp_path / "scores"), str(tmp_path / "checkpoint")

    def run():
        arriving = stream_binary(spark, str(incoming / "*"), pattern="*.bmp", max_files=7)
        features = featurize(
            arriving, not_pretrained_conv(8), file_stack(decode_bitmap, SHAPE), "content", ["path"]
        )
        rows = with_vectors(features).withColumn("class", class_from_path("path"))
        query = score_stream(
            rows, fitted.model, ["path", "features_std_pca", "class"], out, checkpoint
        )
        query.awaitTermination()
        return spark.read.parquet(out)

    for i in range(10):
        (incoming / "Apple Red" / f"{i}.bmp").write_bytes(bmp(picture(i, 20, 20)))
    assert run().count() == 10
    for i in range(10, 15):
        (incoming / "Apple Red" / f"{i}.bmp").write_bytes(bmp(picture(i, 20, 20)))
    scores = run()
    assert scores.count() == 15
    name = F.regexp_extract("path", r"[^/]+$", 0)
    batch = {
        r[0]: r[1]
        for r in table.where("class = 'Apple Red'")
        .select(name, vector_to_array("features_std_pca")).collect()
    }
    for row in scores.select(name.alias("n"), "class", vector_to_array("features_std_pca").alias("v")).collect():
        assert row["class"] == "Apple Red"
        assert np.allclose(row["v"], batch[row["n"]], atol=1e-4)
