from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from fovea.operators import inspect


@pytest.fixture(scope="module")
def keys(spark):
    rows = [("ann", "A1", "s1"), ("bob", "B1", "s2"), ("bob", "B2", "s3")]
    return spark.createDataFrame(
        rows, "`User name` string, `Access key ID` string, `Secret access key` string"
    )


def test_lookup(keys):
    assert inspect.lookup_value(keys, "User name", "ann", "Access key ID") == "A1"
    both = inspect.lookup_row(keys, "User name", "ann", ["Access key ID", "Secret access key"])
    assert tuple(both) == ("A1", "s1")


@pytest.mark.parametrize("name, words", [("eve", "no row"), ("bob", "more than one row")])
def test_lookup_must_find_one(keys, name, words):
    with pytest.raises(LookupError, match=words):
        inspect.lookup_value(keys, "User name", name, "Access key ID")


def test_matching_on_odd_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "`a.b c` int, v string")
    assert [r.v for r in inspect.matching(df, "a.b c", 2).collect()] == ["y"]


def test_schema_table(keys):
    assert [tuple(r) for r in inspect.schema_table(keys.limit(0)).collect()] == [
        ("User name", "string", True),
        ("Access key ID", "string", True),
        ("Secret access key", "string", True),
    ]


def test_schema_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, `b c` string")
    rows = {r["name"]: (r["n_rows"], r["n_null"]) for r in inspect.schema_profile(df).collect()}
    assert rows == {"a": (3, 1), "b c": (3, 2)}


@pytest.mark.parametrize("width", [0, 1, 3, 4, 20, 30])
def test_preview_cells_are_those_of_show(spark, width):
    df = spark.createDataFrame(
        [
            (1, "short", bytearray(b"\x89PNG\r\n"), [1.0, 2.5]),
            (2, "x" * 50, bytearray(range(40)), [0.125] * 9),
            (3, None, None, None),
        ],
        "id int, t string, b binary, a array<double>",
    )
    shown = io.StringIO()
    with redirect_stdout(shown):
        df.orderBy("id").show(truncate=width)
    lines = [line for line in shown.getvalue().splitlines() if line.startswith("|")][1:]
    expected = [[cell.strip() for cell in line.strip("|").split("|")] for line in lines]
    found = inspect.preview(df, truncate=width, order_by="id").collect()
    assert [list(row) for row in found] == expected


def test_preview_takes_the_first_rows(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("x"))
    assert [r.x for r in inspect.preview(df, n=3, order_by="x").collect()] == ["1", "2", "3"]
    plan = inspect.preview(df, n=3, order_by="x")._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan
