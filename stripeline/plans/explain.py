"""What a scan reports of itself."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from ..sources.table import OrcTable


def explain_properties(table: OrcTable, costs: bool = True) -> dict[str, str]:
    """The file, and its size if costs are shown and it exists."""
    from ..sources.footer import data_files

    out = {"Orc File": table.path}
    files = data_files(table.spark, table.path)
    if costs and files:
        out["Orc File Size"] = str(sum(n for _, n in files))
    return out


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def pushed_filters(df: DataFrame) -> list[str]:
    """Filters that the scans take, as Spark names them."""
    return [x for m in re.findall(r"PushedFilters: \[(.*)\]", plan_of(df)) for x in re.split(r", (?=[A-Z])", m) if x]


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_of(df))
