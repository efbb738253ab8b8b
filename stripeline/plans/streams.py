"""Queries over declared tables as streams, each run over the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import orc_table
from ..streaming import finished, late_tolerant_counts, running_totals, sessions
from .registry import query

TIMED = ("start", "end")


def plain(rows: DataFrame) -> DataFrame:
    """Window bounds as wall-clock timestamps."""
    return rows.select(*(F.col(c).cast("timestamp_ntz").alias(c) if c in TIMED else F.col(c) for c in rows.columns))


@query("SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS \"end\", event_type, count(*) AS rows FROM events GROUP BY 1, 2, 3")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    rows = orc_table(spark, d, "events").stream(["ts", "event_type"])
    return plain(finished(late_tolerant_counts(rows, "ts", ["event_type"], "1 hour", "1 day"), "tumbling"))


@query(
    """
    SELECT s AS start, s + INTERVAL 1 HOUR AS "end", event_type, count(*) AS rows
    FROM (SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events)
    GROUP BY 1, 2, 3
    """
)
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    rows = orc_table(spark, d, "events").stream(["ts", "event_type"])
    return plain(finished(late_tolerant_counts(rows, "ts", ["event_type"], "1 hour", "1 day", "30 minutes"), "sliding"))


@query(
    """
    WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM e)
    SELECT min(ts) AS start, max(ts) + INTERVAL 3 HOUR AS "end", user_id, count(*) AS rows FROM s GROUP BY user_id, nth
    """
)
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = orc_table(spark, d, "events").stream(["ts", "user_id"])
    return plain(finished(sessions(rows, "ts", ["user_id"], "3 hours", "1 day"), "sessions"))


@query("SELECT user_id, count(*) AS rows, round(sum(value), 4) AS total, max(value) AS most FROM events GROUP BY user_id")
def stream_state(spark: SparkSession, d: str) -> DataFrame:
    """Keyed state in Python; of each key its last state."""
    rows = orc_table(spark, d, "events").stream(["user_id", "value"])
    found = finished(running_totals(rows, "user_id", "value"), "state", "update")
    last = found.withColumn("_n", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("_batch")))).where("_n = 1")
    return last.select("user_id", "rows", F.round("total", 4).alias("total"), "most")
