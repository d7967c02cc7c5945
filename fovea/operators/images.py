"""From Arrow columns to batch tensors: decoding, shape checks and preprocessing.

A stacker takes one Arrow batch and returns the tensor of the usable rows, in row order, with a
list that holds None for each usable row and a reason for each other one.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from fovea.functions.tensors import IMAGENET_MEANS_BGR

# What decoders raise on corrupt bytes; anything else, such as a full memory, fails the task.
DECODE_ERRORS = (
    ValueError, OSError, EOFError, SyntaxError, LookupError, ArithmeticError, TypeError, struct.error,
)

Stacker = Callable[[pa.Array], tuple[np.ndarray, list]]
Shape = tuple[int, int, int]


def bgr_minus_mean_batch(
    batch: np.ndarray, channel_order: str = "RGB", dtype: type = np.float32
) -> np.ndarray:
    """Image batch (rows, height, width, 3) to BGR floats less the channel means."""
    if channel_order == "RGB":
        batch = batch[..., ::-1]
    elif channel_order != "BGR":
        raise ValueError(f"channel_order must be 'RGB' or 'BGR', not {channel_order!r}")
    return batch.astype(dtype) - np.asarray(IMAGENET_MEANS_BGR, dtype)


def decode_pillow(content: bytes, mode: str | None = None) -> np.ndarray:
    """Any format Pillow reads: (height, width) or (height, width, channels).

    Channels are the file's own unless `mode` converts them, e.g.
    `functools.partial(decode_pillow, mode="RGB")` to accept gray and transparent images too.
    """
    from PIL import Image

    with Image.open(io.BytesIO(content)) as picture:
        return np.asarray(picture.convert(mode) if mode else picture)


def decode_bitmap(content: bytes) -> np.ndarray:
    """Uncompressed 24-bit BMP to an RGB array; needs no codec library."""
    if content[:2] != b"BM":
        raise ValueError("not a bitmap")
    start, width, height = struct.unpack_from("<I4xii", content, 10)
    bits, compression = struct.unpack_from("<HI", content, 28)
    if bits != 24 or compression != 0:
        raise ValueError("only uncompressed 24-bit bitmaps are read")
    stride = (3 * width + 3) // 4 * 4
    rows = np.frombuffer(content, np.uint8, stride * abs(height), start)
    rows = rows.reshape(abs(height), stride)[:, : 3 * width]
    pixels = rows.reshape(abs(height), width, 3)[..., ::-1]
    return pixels[::-1] if height > 0 else pixels


def check_shape(found: tuple, shape: Shape) -> str | None:
    height, width, channels = (*found, 1) if len(found) == 2 else found
    if channels != shape[2]:
        return "wrong channels"
    return None if (height, width) == shape[:2] else "wrong size"


def _prepared(pixels: np.ndarray, order: str, preprocess: bool, dtype: type) -> np.ndarray:
    return bgr_minus_mean_batch(pixels, order, dtype) if preprocess else pixels.astype(dtype)


def file_stack(
    decode: Callable[[bytes], np.ndarray],
    shape: Shape,
    channel_order: str = "RGB",
    preprocess: bool = True,
    dtype: type = np.float32,
) -> Stacker:
    """Raw file bytes, decoded only here, next to the model."""

    def stack(column: pa.Array) -> tuple[np.ndarray, list]:
        images, reasons = [], []
        for content in column.to_pylist():
            reason = "not an image"
            if content is not None:
                try:
                    image = decode(content)
                except DECODE_ERRORS:  # a corrupt file is data, not a failure of the job
                    image = None
                if image is not None:
                    reason = check_shape(image.shape, shape)
                    if reason is None:
                        images.append(image.reshape(shape))
            reasons.append(reason)
        pixels = np.stack(images) if images else np.empty((0, *shape), np.uint8)
        return _prepared(pixels, channel_order, preprocess, dtype), reasons

    return stack


def image_stack(shape: Shape, preprocess: bool = True, dtype: type = np.float32) -> Stacker:
    """Structs of the JVM image reader, whose bytes are already BGR."""
    expected = dict(zip(("height", "width", "nChannels"), shape))
    size = int(np.prod(shape))

    def stack(column: pa.Array) -> tuple[np.ndarray, list]:
        fields = {name: column.field(name).to_numpy(zero_copy_only=False) for name in expected}
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        valid = valid & (fields["height"] >= 0)
        channels = fields["nChannels"] == expected["nChannels"]
        fits = (fields["height"] == expected["height"]) & (fields["width"] == expected["width"])
        good = valid & channels & fits
        reasons = np.select(
            [~valid, ~channels, ~fits], ["not an image", "wrong channels", "wrong size"], ""
        )
        data = column.field("data").filter(pa.array(good))
        pixels = np.frombuffer(b"".join(data.to_pylist()), np.uint8, size * len(data))
        tensor = _prepared(pixels.reshape(len(data), *shape), "BGR", preprocess, dtype)
        return tensor, [reason or None for reason in reasons.tolist()]

    return stack


def tensor_stack(shape: tuple[int, ...], dtype: type = np.float32) -> Stacker:
    """Flat numeric arrays, one tensor of `shape` per row."""
    size = int(np.prod(shape))

    def stack(column: pa.Array) -> tuple[np.ndarray, list]:
        present = column.is_valid().to_numpy(zero_copy_only=False)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        fits = lengths == size
        values = column.filter(pa.array(present & fits)).flatten()
        has_null = values.null_count > 0
        if has_null:
            nulls = values.is_null().to_numpy(zero_copy_only=False).reshape(-1, size).any(axis=1)
        reasons = np.select([~present, ~fits], ["missing", "wrong width"], "")
        tensor = values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
        tensor = tensor.reshape(-1, *shape)
        if has_null:
            reasons = reasons.astype(object)
            reasons[np.flatnonzero(present & fits)[nulls]] = "not finite"
            tensor = tensor[~nulls]
        return tensor, [reason or None for reason in reasons.tolist()]

    return stack
