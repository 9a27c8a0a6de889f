"""Every registered query against its SQL twin over the given tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(spark, sf_dir, QUERIES[name], ORACLE_SQL[name], con) is None
