"""Every query of the catalogue against its SQL, and the driver's entry points."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from check_oracles import connect, difference

import __spark_entry__ as spark_entry
from conftest import ROOT
from fovea.plans.catalogue import QUERIES
from fovea.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = spark_entry.queries()[name](spark, sf_dir)
    rows, problem = difference(df, duck, ORACLES[name])
    assert problem == ""
    assert rows > 0


def test_every_query_has_its_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_points_without_the_optional_parts(tmp_path):
    """As if the optional subpackage and the pipeline had been deleted."""
    shutil.copytree(
        os.path.join(ROOT, "fovea"), tmp_path / "fovea", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert found.stdout.split("\n")[:2] == [" ".join(sorted(QUERIES))] * 2


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["vec_id", "class", "k", "component", "value"]
    assert df.select("vec_id").distinct().count() == 500
