from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest
from fixture_files import bmp, png
from pyspark.sql import functions as F

from conftest import picture
from fovea.functions import tensors
from fovea.operators import images
from fovea.sources.files import read_images

MEANS = np.array([103.939, 116.779, 123.68])


@pytest.mark.parametrize("top_down", [False, True])
@pytest.mark.parametrize("size", [(8, 8), (5, 3), (1, 1), (100, 99)])
def test_decode_bitmap(size, top_down):
    pixels = picture(1, *size)
    assert (images.decode_bitmap(bmp(pixels, top_down)) == pixels).all()


@pytest.mark.parametrize("content", [b"", b"\x89PNG", b"BM", bmp(picture(1, 4, 4))[:80]])
def test_decode_bitmap_refuses(content):
    with pytest.raises((ValueError, struct.error)):
        images.decode_bitmap(content)


def test_decode_pillow():
    pytest.importorskip("PIL")
    pixels = picture(3, 6, 5)
    assert (images.decode_pillow(png(pixels)) == pixels).all()
    gray = picture(4, 6, 5, 1)
    assert images.decode_pillow(png(gray)).shape == (6, 5)
    assert (images.decode_pillow(png(gray), mode="RGB") == gray).all()


def test_preprocessing_flips_rgb_only():
    batch = np.stack([picture(1), picture(2)])
    expected = batch[..., ::-1] - MEANS
    rgb = images.bgr_minus_mean_batch(batch, "RGB")
    assert rgb.dtype == np.float32 and np.allclose(rgb, expected, atol=1e-4)
    bgr = images.bgr_minus_mean_batch(batch[..., ::-1], "BGR")
    assert (bgr == rgb).all()
    with pytest.raises(ValueError):
        images.bgr_minus_mean_batch(batch, "GRB")


def test_column_preprocessing_is_the_batch_one(spark):
    pixels = picture(5, 3, 4)
    df = spark.createDataFrame([(pixels.reshape(-1).tolist(),), (None,)], "p array<int>")
    found = [r[0] for r in df.select(tensors.bgr_minus_mean("p")).collect()]
    expected = images.bgr_minus_mean_batch(pixels[None], "RGB", np.float64).reshape(-1)
    assert np.allclose(found[0], expected) and found[1] is None


def test_file_stack_sorts_out_bad_rows():
    good = [bmp(picture(i, 8, 8)) for i in range(3)]
    column = pa.array([good[0], None, b"junk", bmp(picture(9, 4, 8)), good[1], good[2]])
    stack = images.file_stack(images.decode_bitmap, (8, 8, 3), preprocess=False)
    tensor, reasons = stack(column)
    assert reasons == [None, "not an image", "not an image", "wrong size", None, None]
    assert (tensor == np.stack([picture(i, 8, 8) for i in range(3)])).all()
    tensor, reasons = stack(pa.array([b"junk"]))
    assert tensor.shape == (0, 8, 8, 3) and reasons == ["not an image"]


def test_file_stack_reports_a_missing_decoder_library():
    def decode(content):
        raise ImportError("no such library")

    with pytest.raises(ImportError):
        images.file_stack(decode, (8, 8, 3))(pa.array([b"x"]))


def test_gray_images_have_the_wrong_channels():
    stack = images.file_stack(lambda content: np.zeros((8, 8)), (8, 8, 3))
    assert stack(pa.array([b"x"]))[1] == ["wrong channels"]
    gray = images.file_stack(lambda content: np.ones((8, 8)), (8, 8, 1), preprocess=False)
    tensor, reasons = gray(pa.array([b"x"]))
    assert tensor.shape == (1, 8, 8, 1) and reasons == [None]


def test_tensor_stack():
    stack = images.tensor_stack((2, 2))
    column = pa.array([[1, 2, 3, 4], None, [1, 2], [1, None, 3, 4], [5, 6, 7, 8]], pa.list_(pa.float32()))
    tensor, reasons = stack(column)
    assert reasons == [None, "missing", "wrong width", "not finite", None]
    assert tensor.tolist() == [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]
    tensor, reasons = stack(column.slice(1, 2))
    assert len(tensor) == 0 and reasons == ["missing", "wrong width"]
    assert stack(column.slice(4))[0].tolist() == [[[5, 6], [7, 8]]]


def test_image_reasons(spark, image_root):
    found = (
        read_images(spark, image_root + "/*")
        .select(
            F.regexp_extract("image.origin", "[^/]+$", 0).alias("name"),
            tensors.image_reject_reason("image", (100, 100, 3)).alias("reason"),
        )
        .where("reason is not null")
    )
    assert {r["name"]: r["reason"] for r in found.collect()} == {
        "gray.png": "wrong channels",
        "rgba.png": "wrong channels",
        "bad.png": "not an image",
        "notes.txt": "not an image",
        "small.png": "wrong size",
        "readme.txt": "not an image",
    }


@pytest.mark.parametrize("how", ["max", "avg"])
@pytest.mark.parametrize("positions, channels", [(1, 1), (1, 4), (9, 5), (16, 4)])
def test_global_pool(spark, how, positions, channels):
    values = np.random.default_rng(positions).normal(size=(20, positions, channels))
    df = spark.createDataFrame([(v.reshape(-1).tolist(),) for v in values], "t array<float>")
    found = [r[0] for r in df.select(tensors.global_pool("t", channels, how)).collect()]
    values = values.astype(np.float32).astype(np.float64)
    expected = values.max(axis=1) if how == "max" else values.mean(axis=1)
    assert np.allclose(found, expected)


@pytest.mark.parametrize("how", ["max", "avg"])
def test_global_pool_refuses_a_ragged_length(spark, how):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 99.0],)], "t array<double>")
    with pytest.raises(Exception, match="no multiple of 3"):
        df.select(tensors.global_pool("t", 3, how)).collect()


def test_only_corrupt_files_become_rejects():
    def fail(error):
        def decode(content):
            raise error

        return images.file_stack(decode, (2, 2, 3))

    for error in (ValueError("x"), OSError("x"), struct.error("x"), IndexError("x")):
        assert fail(error)(pa.array([b"1"]))[1] == ["not an image"]
    for error in (MemoryError(), ImportError(), RuntimeError()):
        with pytest.raises(type(error)):
            fail(error)(pa.array([b"1"]))


def test_global_pool_refuses_other_kinds():
    with pytest.raises(ValueError):
        tensors.global_pool("t", 4, "median")


def test_flatten_levels(spark):
    df = spark.createDataFrame([([[[1, 2], [3]], [[4]]],)], "t array<array<array<int>>>")
    assert df.select(tensors.flatten_tensor("t", 2)).first()[0] == [1, 2, 3, 4]


def test_feature_reasons(spark):
    rows = [[1.0, 2.0], None, [1.0], [1.0, float("nan")], [float("inf"), 0.0], [None, 1.0]]
    df = spark.createDataFrame([(r,) for r in rows], "f array<double>")
    found = [r[0] for r in df.select(tensors.feature_reject_reason("f", 2)).collect()]
    assert found == [None, "missing", "wrong width"] + ["not finite"] * 3
