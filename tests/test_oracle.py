"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from conftest import SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SMALL)
    if name in ORACLE:
        assert r["match"], r
    else:
        assert r["rows"] > 0, r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["location", "section_rank", "row_rank", "pos", "row_kind", "text", "price"]
    assert df.count() > 0
