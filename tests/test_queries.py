"""Every registered query beside its SQL, with whole groups and with groups cut into many slices."""

import compare
import pytest
from conftest import SMALL

from tidemark.queries import all_queries

QUERIES = all_queries()
#: Queries whose result depends on the order of rows inside a group.
ORDERED = [n for n in QUERIES if QUERIES[n].sql and n.split("_")[0] in (
    "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 t1 t11 s9 c6 c7 c10 c12 a8 a17 l1 p26 x1 x2 x3 x4".split())]


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    q = QUERIES[name]
    got = compare.spark_rows(q.run(spark, SMALL))
    if q.sql is None:
        assert got[1]
    else:
        assert compare.difference(got, compare.duck_rows(duck, q.sql)) is None


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_cut_groups(spark, duck, tiny_slices, name):
    q = QUERIES[name]
    assert compare.difference(compare.spark_rows(q.run(spark, SMALL)), compare.duck_rows(duck, q.sql)) is None


def test_names_follow_the_inventory():
    assert all(n.split("_")[0][0] in "sptawcjulxf" and n.split("_")[0][1:].isdigit() for n in QUERIES)
