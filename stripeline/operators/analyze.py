"""Statistics of declared tables: a sample of exact size, totals, column statistics, and a planner's estimates."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.footer import data_files
from ..sources.table import OrcTable

log = logging.getLogger(__name__)
#: A planner's block size, alignment and row header.
BLOCK, ALIGN, HEADER = 8192, 8, 24
SEQ_PAGE_COST, CPU_TUPLE_COST, TUPLE_FACTOR = 1.0, 0.01, 10


def aligned(n: int) -> int:
    return -(-n // ALIGN) * ALIGN


@dataclass(frozen=True)
class Estimate:
    pages: int
    rows: float
    startup_cost: float
    total_cost: float


def pages_of(table: OrcTable) -> int:
    """Blocks of the files; ten if there are none yet."""
    size = sum(n for _, n in data_files(table.spark, table.path)) or 10 * BLOCK
    return max(1, -(-size // BLOCK))


def estimate(table: OrcTable, selectivity: float = 1.0, analyzed: tuple[int, int] | None = None, filter_cost: float = 0.0) -> Estimate:
    """Rows from the (pages, rows) of an earlier analysis, scaled by the pages there are now, or else from file size and row
    width; and the cost of a scan, in which a tuple costs ten times a usual one."""
    pages = pages_of(table)
    if analyzed and analyzed[0] > 0:
        rows = analyzed[1] / analyzed[0] * pages
    else:
        width = aligned(sum(t.width for _, t in table.columns)) + HEADER
        size = sum(n for _, n in data_files(table.spark, table.path)) or 10 * BLOCK
        rows = size / width
    rows = max(1.0, round(rows))
    cost = SEQ_PAGE_COST * pages + (CPU_TUPLE_COST * TUPLE_FACTOR + filter_cost) * rows
    return Estimate(pages, max(1.0, round(rows * selectivity)), 0.0, cost)


def sample(rows: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows (all, if there are fewer), each set of n as likely; a top-n by a random number, so no task holds more than n."""
    return rows.orderBy(F.rand(seed)).limit(n)


def analyze(table: OrcTable, n: int = 30_000, seed: int = 0) -> tuple[DataFrame, int, int]:
    """A sample of n rows of all columns, the number of rows, and of dead rows (there are none)."""
    rows = table.scan()
    total = table.count().first()["count"]
    log.info('"%s": file contains %d rows; %d rows in sample', table.name, total, min(n, total))
    return sample(rows, n, seed), total, 0


def column_statistics(rows: DataFrame) -> DataFrame:
    """A row for each column: null share, distinct values (approximate), least and greatest value as text, mean length. One pass."""
    parts = []
    for c, kind in rows.dtypes:
        col, plain = F.col(f"`{c}`"), not kind.startswith("array")
        text = col.cast("string")
        parts.append(
            F.struct(
                F.lit(c).alias("column"), F.avg(col.isNull().cast("double")).alias("null_share"),
                (F.approx_count_distinct(col) if plain else F.approx_count_distinct(text)).alias("distinct"),
                (F.min(col).cast("string") if plain else F.lit(None).cast("string")).alias("least"),
                (F.max(col).cast("string") if plain else F.lit(None).cast("string")).alias("greatest"),
                F.avg(F.octet_length(text)).alias("mean_bytes"),
            )
        )
    return rows.agg(F.array(*parts).alias("all")).select(F.inline("all"))
