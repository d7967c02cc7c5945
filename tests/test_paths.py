from __future__ import annotations

from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fovea.functions import paths


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_class_from_path(spark):
    df = column(spark, ["a/b/c", "c", "", None, "a/b/", "/root/Apple Red/3.png"])
    found = [r[0] for r in df.select(paths.class_from_path("x")).collect()]
    assert found == ["b", None, None, None, "b", "Apple Red"]


def test_percent_encode_fixed(spark):
    df = column(spark, ["aB9/+=~ *_.-é%", "S/K+=", "", None])
    found = [r[0] for r in df.select(paths.percent_encode("x")).collect()]
    assert found == ["aB9%2F%2B%3D~%20%2A_.-%C3%A9%25", "S%2FK%2B%3D", "", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=20, max_size=60))
def test_percent_encode_as_python(spark, texts):
    found = [r[0] for r in column(spark, texts).select(paths.percent_encode("x")).collect()]
    assert found == [quote(text, safe="") for text in texts]


def test_format_uri(spark):
    df = spark.createDataFrame([("bucket", "a b", 3)], "b string, k string, n int")
    uri = paths.format_uri("s3a://%s/%s/%d", "b", paths.percent_encode("k"), "n")
    assert df.select(uri).first()[0] == "s3a://bucket/a%20b/3"


@pytest.mark.parametrize(
    "origin, path",
    [
        ("file:///data/Apple%20Red/1+1.png", "file:/data/Apple Red/1+1.png"),
        ("s3a://bucket/Plum/2.png", "s3a://bucket/Plum/2.png"),
    ],
)
def test_plain_path(spark, origin, path):
    assert column(spark, [origin]).select(paths.plain_path(F.col("x"))).first()[0] == path
