from __future__ import annotations

import os
import sys

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixture_files import png  # noqa: E402
from fovea.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "fovea-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def picture(seed: int, height: int = 100, width: int = 100, channels: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 256, (height, width, channels), np.uint8)


@pytest.fixture(scope="session")
def image_root(tmp_path_factory):
    """A class tree: good images, other shapes, files that are no images, a file in the root."""
    root = tmp_path_factory.mktemp("trees") / "training set"
    for name in ("Apple Red", "Pear", "Plum"):
        (root / name).mkdir(parents=True)
    for seed in range(6):
        (root / "Apple Red" / f"{seed}.png").write_bytes(png(picture(seed)))
    for seed in range(6, 10):
        (root / "Plum" / f"{seed}.png").write_bytes(png(picture(seed)))
    (root / "Pear" / "gray.png").write_bytes(png(picture(20, channels=1)))
    (root / "Pear" / "rgba.png").write_bytes(png(picture(21, channels=4)))
    (root / "Pear" / "bad.png").write_bytes(png(picture(22))[:60])
    (root / "Pear" / "notes.txt").write_text("not an image")
    (root / "Plum" / "small.png").write_bytes(png(picture(23, 2, 2)))
    (root / "readme.txt").write_text("no class")
    return str(root)
