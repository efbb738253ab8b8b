"""Windowed aggregation and keyed state over a stream of new ORC files (OrcTable.stream)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import shared_dir


def _timed(rows: DataFrame, time: str, columns: list[str], late: str) -> DataFrame:
    return rows.select(F.col(time).cast("timestamp").alias(time), *columns).withWatermark(time, late)


def late_tolerant_counts(rows: DataFrame, time: str, keys: list[str], width: str, late: str, slide: str | None = None) -> DataFrame:
    """Rows per key and event-time window, tumbling or sliding; rows later than the watermark are left out."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    counts = _timed(rows, time, keys, late).groupBy(window, *keys).agg(F.count("*").alias("rows"))
    return counts.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "rows")


def sessions(rows: DataFrame, time: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """Rows per key and session: a session ends where nothing comes for the gap."""
    counts = _timed(rows, time, keys, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("rows"))
    return counts.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "rows")


def running_totals(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, rows, total, most, after each micro-batch in which the key comes: state is two numbers and a greatest value for each key."""

    def update(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, total, most = state.get if state.exists else (0, 0.0, float("-inf"))
        for batch in batches:
            n, total, most = n + len(batch), total + float(batch[value].sum()), max(most, float(batch[value].max()))
        state.update((n, total, most))
        yield pd.DataFrame({key: [group[0]], "rows": [n], "total": [total], "most": [most]})

    kind = dict(rows.dtypes)[key]
    return rows.select(key, value).groupBy(key).applyInPandasWithState(update, f"{key} {kind}, rows long, total double, most double", "n long, total double, most double", "update", "NoTimeout")


def finished(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs the stream over what is there now and returns its last result, written to the shared folder: with mode complete the whole result
    after each batch, with mode update each batch's rows with its number (_batch)."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(rows: DataFrame, batch: int) -> None:
        if mode == "complete":
            rows.write.mode("overwrite").parquet(f"{path}/rows")
        else:
            rows.withColumn("_batch", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    schema = stream.schema if mode == "complete" else StructType([*stream.schema.fields, StructField("_batch", IntegerType())])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/rows")
