import duckdb
import pytest

from stripeline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall())
