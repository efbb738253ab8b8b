"""What the operators of this subpackage share: tables, shared storage, code shipping, Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

_shipped: set[str] = set()
_staged: dict[str, list[str]] = {}
#: Whole texts travel in Arrow batches, held by the executor and its Python worker at once: smaller than usual, unless a session has its own sizes.
ARROW = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16m"))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, through the shared folder, so that workers import it whatever their path is."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = new_folder(spark, "stripeline") + ".zip"
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(blob.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
    for name, usual, own in ARROW:
        if spark.conf.get(name) == usual:
            spark.conf.set(name, own)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes the tables that stage() wrote in this application. Results that still read them can't be used afterwards."""
    for path in _staged.pop(spark.sparkContext.applicationId, []):
        drop_folder(spark, path)


def partitions(df: DataFrame, grows: float = 1.0, each: int = 64 << 20) -> int:
    """Shuffle partitions for what is made of df, grows times its size: the session's number, or more, so that a partition stays near each bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(1 << 20, int(size * grows / each)) if size < 1 << 60 else 0)


#: A value that over a HOT-th of all rows have is joined by broadcast: there are fewer than HOT such values.
HOT = 1000


def join_by(rows: DataFrame, one: DataFrame, on: list[str], hot: Column, few: bool = False) -> DataFrame:
    """rows joined to the table one, which has one row for each value of on. The rows of hot values stay where they are, as
    their rows of one are broadcast; the others meet by shuffle. few: the whole of one is small, by a bound that the caller states."""
    if few:
        return rows.join(F.broadcast(one), on)
    most = one.where(hot)
    rest = rows.join(F.broadcast(most.select(*on)), on, "left_anti").join(one.where(~hot), on)
    return rows.join(F.broadcast(most), on).unionByName(rest)


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release() -> None:
    """Gives memory that isn't used back to the system: a Python worker stays for other tasks, idle ones beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with one state per task: make() builds the function that maps each record batch; not called where there is none."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            f = f or make()
            yield f(batch)
        release()

    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null: empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
