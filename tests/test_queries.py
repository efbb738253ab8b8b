"""Every registered query of the engine against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from stripeline.plans import queries as engine


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(engine.oracle_sql()))
def test_query(spark, sf, duck, name):
    got = engine.queries()[name](spark, sf)
    want = duck.sql(engine.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = sorted(repr([plain(r[c]) for c in columns]) for r in got.collect())
    theirs = sorted(repr([plain(r[want.columns.index(c)]) for c in columns]) for r in want.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(engine.queries()) - set(engine.oracle_sql())))
def test_query_without_sql(spark, sf, name):
    assert engine.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 12
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_aggregates_by_hash_and_by_sort(spark, sf):
    """Numbers are aggregated in place; text, which has no fixed width, in order."""
    plan = lambda name: engine.queries()[name](spark, sf)._jdf.queryExecution().toString()
    assert "HashAggregate(" in plan("group_hashed") and "SortAggregate(" not in plan("group_hashed")
    assert "SortAggregate(" in plan("group_sorted")


def test_no_query_is_vacuous(spark, sf, duck):
    """Each query's SQL gives rows, but for those that are about finding none."""
    empty = {name for name, text in engine.oracle_sql().items() if not duck.sql(text).limit(1).fetchall()}
    assert empty <= {"filter_empty", "bigrow_short_none", "bigrow_int_none"}
