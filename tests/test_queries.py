"""Every registered query outside of the text operators against its DuckDB counterpart on the smallest tables."""

import duckdb
import pytest

from tidewell.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(cols).collect())))
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    want = sorted(map(repr, rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall()))
    assert got == want
