"""Every registered query against its DuckDB oracle at sf0.001 (row count,
columns, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from rosterlens.plans.registry import QUERIES
from tools.compare_oracle import digest, duck_connect

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    assert len(s_rows) == len(d_rows)
    assert digest(s_rows, sdf.columns, order)[0] == digest(d_rows, rel.columns, order)[0]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["class", "most_popular_subclass", "subclass_count"]
    assert df.count() > 0
