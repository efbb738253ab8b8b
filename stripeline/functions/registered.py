"""Functions for a session's SQL. Expressions are registered as SQL functions, so that they stay in the JVM; Python only where it's a user's own code."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SQL = (
    "bucket_of(x DOUBLE, low DOUBLE, high DOUBLE, n BIGINT) RETURNS BIGINT RETURN width_bucket(x, low, high, n)",
    "rendered(items ARRAY<BIGINT>) RETURNS STRING RETURN concat('{', concat_ws(',', CAST(items AS ARRAY<STRING>)), '}')",
    "char_of(text STRING, size INT) RETURNS STRING RETURN rpad(text, size, ' ')",
    "counted(n BIGINT) RETURNS TABLE(nth BIGINT) RETURN SELECT id AS nth FROM (SELECT explode(CASE WHEN n > 0 THEN sequence(CAST(1 AS BIGINT), n) ELSE array() END) AS id)",
)


def register(spark: SparkSession) -> None:
    """bucket_of, rendered, char_of, counted (a table function) and titled, for this session."""
    for text in SQL:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")

    def titled(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:  # defined here, it travels by value
        for text in texts:
            yield text.str.capitalize()

    kinds = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    titled.__annotations__ = kinds
    spark.udf.register("titled", F.pandas_udf(titled, "string"))
