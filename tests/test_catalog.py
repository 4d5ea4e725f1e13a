"""Catalog sanity: oracles belong to registered queries and every oracle SQL plans in DuckDB."""

import pytest

from conftest import SMALL
from oracle_compare import duck

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


def test_oracles_belong_to_queries():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_sql_plans(name):
    con = duck(SMALL)
    con.execute("EXPLAIN " + ORACLE[name])
