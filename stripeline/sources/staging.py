"""Parquet tables as ORC files, made once per session and settings, in the shared folder."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from itertools import accumulate
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .footer import data_files, read_footer, remove
from .table import OrcTable, write_orc

_staged: dict[tuple, str] = {}


def made(spark: SparkSession, key: tuple, rows: Callable[[], Any], codec: str = "zlib", stride: int = 10_000, write: Callable[[Any, str], Any] | None = None) -> str:
    """Path of rows() as ORC, written on first use; or of what write(rows(), path) makes there."""
    key = (spark.sparkContext.applicationId, *key, codec, stride)
    if key not in _staged:
        path = f"{shared_dir(spark).rstrip('/')}/orc-{uuid.uuid4().hex}"
        if write:
            write(rows(), path)
        else:
            write_orc(rows(), path, codec, stride)
        _staged[key] = path
    return _staged[key]


def staged(spark: SparkSession, sf_dir: str, name: str, codec: str = "zlib", stride: int = 10_000) -> str:
    return made(spark, (sf_dir, name), lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"), codec, stride)


def orc_table(spark: SparkSession, sf_dir: str, name: str, **how) -> OrcTable:
    return OrcTable.of(spark, name, staged(spark, sf_dir, name, **how))


#: Spark hands rows to ORC's writer in batches of so many, and a stripe ends only after a batch.
BATCH = 1024
#: Stripes of a file in order of a column.
STRIPES = 8


def write_ordered(rows: DataFrame, path: str, by: str, stride: int, stripes: int = STRIPES) -> str:
    """Rows in ascending order of a column, nulls last, as ORC whose row groups are runs of ``stride`` of them over all files: only the
    last run may be shorter. A row group ends with its stripe and file, so these are cut after whole runs.

    Sorted parts are written beside the result for the time of it, as sorting twice may cut the parts in different places."""
    spark, parts = rows.sparkSession, f"{path}-parts"
    try:
        write_orc(rows.sort(F.asc_nulls_last(by)).withColumn("_at", F.monotonically_increasing_id()), parts)
        found = spark.read.orc(parts).withColumn("_part", F.shiftright("_at", 33))
        sizes = found.groupBy("_part").count().orderBy("_part").collect()
        before = [0, *accumulate(n for _, n in sizes)]
        starts = spark.createDataFrame([(part, n) for (part, _), n in zip(sizes, before, strict=False)], "_part long, _before long")
        whole = math.lcm(stride, BATCH)
        file = F.expr(f"CAST((_before + (_at & {2**33 - 1})) div {whole * stripes} AS INT)")
        placed = found.join(F.broadcast(starts), "_part").repartitionById(max(1, -(-before[-1] // (whole * stripes))), file)
        write_orc(placed.sortWithinPartitions("_at").select(*rows.columns), path, stride=stride, **{"orc.stripe.row.count": str(whole)})
    finally:
        remove(spark, parts)
    written = [s.rows for p, _ in data_files(spark, path) for s in read_footer(spark, p).stripes]
    if any(n % stride for n in written[:-1]):
        raise RuntimeError(f"rows of {path} are too wide: stripes ended before {whole} rows, within runs of {stride}")
    return path


def ordered_table(spark: SparkSession, sf_dir: str, name: str, by: str, stride: int) -> OrcTable:
    rows = lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return OrcTable.of(spark, name, made(spark, ("ordered", sf_dir, name, by), rows, stride=stride, write=lambda r, path: write_ordered(r, path, by, stride)))
