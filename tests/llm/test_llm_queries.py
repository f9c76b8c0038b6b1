"""Every registered query over the smallest tables, beside its SQL where it has one."""

import compare
import pytest
from llm_tables import SMALL

import __spark_entry__ as registered
from tidemark import llm

QUERIES = llm.all_queries()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = compare.spark_rows(QUERIES[name].run(spark, SMALL))
    if QUERIES[name].sql is None:
        assert got[1]
    else:
        assert compare.difference(got, compare.duck_rows(duck, QUERIES[name].sql)) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = registered.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert "pipeline" in names
