"""Queries against their SQL, and the registry."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference
from tillroll.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_statement(spark, name):
    assert difference(QUERIES[name](spark, SF), SF, ORACLE[name]) is None


def test_registry():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
