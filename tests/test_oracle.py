"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same gate at sf0.01)."""

import pytest

import __spark_entry__ as E
from stargrain.plans import catalog
from tools.oracle_check import compare, duck, spark_type

SF = "/root/testdata/sf0.001"
SQL = catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows is not None
        return
    rel = con.sql(SQL[name])
    msgs = compare(rows, df.columns, [spark_type(f.dataType.simpleString()) for f in df.schema.fields],
                   rel.fetchall(), rel.columns, [str(t) for t in rel.types])
    assert not msgs, msgs


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_registry_consistency():
    assert set(SQL) <= set(catalog.QUERIES) <= set(E.queries())
    assert set(SQL) <= set(E.oracle_sql())
    assert set(catalog.QUERIES) == set(SQL)
