"""Small writers for test files: PNG and bitmap images, and an ONNX network."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def png(pixels: np.ndarray) -> bytes:
    height, width, channels = pixels.shape
    color = {1: 0, 3: 2, 4: 6}[channels]

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = b"".join(b"\0" + row.tobytes() for row in pixels)
    header = struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(rows))
        + chunk(b"IEND", b"")
    )


def bmp(pixels: np.ndarray, top_down: bool = False) -> bytes:
    height, width, _ = pixels.shape
    rows = pixels[..., ::-1] if top_down else pixels[::-1, :, ::-1]
    padding = b"\0" * (-3 * width % 4)
    body = b"".join(row.tobytes() + padding for row in rows)
    signed = -height if top_down else height
    info = struct.pack("<IiiHHIIiiII", 40, width, signed, 1, 24, 0, len(body), 0, 0, 0, 0)
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + info + body


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes | str) -> bytes:
    value = value.encode() if isinstance(value, str) else value
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _tensor_info(name: str, dims: list) -> bytes:
    shape = b"".join(
        _bytes(1, _bytes(2, d) if isinstance(d, str) else _number(1, d)) for d in dims
    )
    kind = _bytes(1, _number(1, 1) + _bytes(2, shape))
    return _bytes(1, name) + _bytes(2, kind)


def onnx_conv(weights: np.ndarray, height: int, width: int) -> bytes:
    """Input x (N, 3, height, width) -> 3x3 convolution -> ReLU -> output y, in ONNX's format."""
    outputs = weights.shape[0]
    initializer = (
        b"".join(_number(1, d) for d in weights.shape)
        + _number(2, 1)
        + _bytes(8, "w")
        + _bytes(9, weights.astype(np.float32).tobytes())
    )
    conv = _bytes(1, "x") + _bytes(1, "w") + _bytes(2, "c") + _bytes(4, "Conv")
    relu = _bytes(1, "c") + _bytes(2, "y") + _bytes(4, "Relu")
    graph = (
        _bytes(1, conv)
        + _bytes(1, relu)
        + _bytes(2, "g")
        + _bytes(5, initializer)
        + _bytes(11, _tensor_info("x", ["n", 3, height, width]))
        + _bytes(12, _tensor_info("y", ["n", outputs, height - 2, width - 2]))
    )
    opset = _bytes(8, _bytes(1, "") + _number(2, 13))
    return _number(1, 8) + opset + _bytes(7, graph)
