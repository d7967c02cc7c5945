"""Model factories for `featurize`. Pretrained weights are supplied by the user."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

Model = Callable[[np.ndarray], np.ndarray]

# Broadcast weights travel through the driver; larger models go out as files.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def pool_batch(feature_maps: np.ndarray, how: str | None) -> np.ndarray:
    """(rows, height, width, channels) to (rows, channels), or unchanged for None."""
    if how is None:
        return feature_maps
    if how == "max":
        return feature_maps.max(axis=(1, 2))
    if how == "avg":
        return feature_maps.mean(axis=(1, 2))
    raise ValueError(f"pooling must be 'max', 'avg' or None, not {how!r}")


def pooling_model(how: str) -> Callable[[], Model]:
    """Global pooling alone, for inputs that already are feature maps."""
    return lambda: lambda batch: pool_batch(batch, how)


def linear_model(
    spark: SparkSession,
    weights: np.ndarray,
    relu: bool = True,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> Callable[[], Model]:
    """Flattened input times broadcast `weights` (inputs x outputs)."""
    if weights.nbytes > max_broadcast_bytes:
        raise ValueError("weights too large to broadcast; use onnx_model")
    shared = spark.sparkContext.broadcast(weights)

    def load() -> Model:
        matrix = shared.value

        def predict(batch: np.ndarray) -> np.ndarray:
            output = batch.reshape(len(batch), -1) @ matrix
            return np.maximum(output, 0) if relu else output

        return predict

    return load


def onnx_model(
    spark: SparkSession,
    path: str,
    channels_first: bool = True,
    pooling: str | None = None,
    threads: int = 1,
) -> Callable[[], Model]:
    """A network in an ONNX file, sent to every executor once.

    `pooling` is applied to a four-dimensional output. One thread per session, because Spark
    already runs one Python worker per core; raise it together with spark.task.cpus.
    """
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    def load() -> Model:
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = threads
        session = onnxruntime.InferenceSession(
            SparkFiles.get(name), options, providers=["CPUExecutionProvider"]
        )
        source = session.get_inputs()[0].name

        def predict(batch: np.ndarray) -> np.ndarray:
            if channels_first:
                batch = np.ascontiguousarray(batch.transpose(0, 3, 1, 2))
            output = session.run(None, {source: batch})[0]
            if output.ndim == 4 and channels_first:
                output = output.transpose(0, 2, 3, 1)
            return pool_batch(output, pooling) if output.ndim == 4 else output

        return predict

    return load


def not_pretrained_conv(
    channels: int = 512, pooling: str | None = "max", stride: int = 4, seed: int = 0
) -> Callable[[], Model]:
    """One 3x3 convolution with ReLU and seeded random weights.

    A stand-in with the output width of the usual image network, for tests and load runs where no
    trained weights are at hand. Its features say nothing about the pictures' content.
    """

    def load() -> Model:
        kernel = np.random.default_rng(seed).normal(0, 0.1, (27, channels)).astype(np.float32)

        def convolve(images: np.ndarray) -> np.ndarray:
            windows = np.lib.stride_tricks.sliding_window_view(images, (3, 3), axis=(1, 2))
            windows = windows[:, ::stride, ::stride].transpose(0, 1, 2, 4, 5, 3)
            rows, height, width = windows.shape[:3]
            maps = windows.reshape(rows * height * width, 27).astype(np.float32) @ kernel
            maps = np.maximum(maps, 0).reshape(rows, height, width, channels)
            return pool_batch(maps, pooling)

        def predict(batch: np.ndarray) -> np.ndarray:
            # a few images at a time: the maps of a whole batch would take gigabytes
            parts = [convolve(batch[at : at + 32]) for at in range(0, len(batch), 32)]
            return np.concatenate(parts)

        return predict

    return load
