"""Every registered query against DuckDB over the smallest tables."""

import pytest

from alarmloom.plans.catalog import ORACLE, QUERIES
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, small_dir, name):
    ok, note, _ = compare(spark, duck, QUERIES[name], ORACLE[name], small_dir)
    assert ok, note
