"""Registered queries of the subpackage against their SQL."""

from __future__ import annotations

import pytest
from check_oracles import connect, difference

import __spark_entry__ as spark_entry
from fovea.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(name, spark, sf_dir):
    rows, problem = difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert problem == "" and rows > 0


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(spark_entry.queries())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
