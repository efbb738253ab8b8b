"""How queries are registered, and the tables that they read."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import orc_table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def take(f: Query) -> Query:
        _queries[name or f.__name__] = f
        if oracle:
            _oracles[name or f.__name__] = oracle
        return f

    return take


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


def scan(spark: SparkSession, d: str, name: str, columns: list[str] | None = None, **how) -> DataFrame:
    return orc_table(spark, d, name, **how).scan(columns)


def simple(name: str, table: str, oracle: str, make: Callable[[DataFrame], DataFrame], **how) -> None:
    query(oracle, name)(lambda spark, d: make(scan(spark, d, table, **how)))


def sql(name: str, text: str, oracle: str | None = None) -> None:
    """The same text for Spark and DuckDB, unless the oracle is given; {x} names table x."""
    tables = sorted(set(re.findall(r"\{(\w+)\}", text)))

    def run(spark: SparkSession, d: str) -> DataFrame:
        return spark.sql(text, **{t: scan(spark, d, t) for t in tables})

    query(oracle or re.sub(r"\{(\w+)\}", r"\1", text), name)(run)
