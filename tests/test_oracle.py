"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from flowlens.plans.registry import QUERIES
from flowlens_oracle import ORACLE_SQL as ORACLE
from tools.check import digest

from .conftest import SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "region_scope" in df.columns
