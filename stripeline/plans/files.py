"""Writing tables and reading them back: text to ORC, partitioned folders, bloom filters, other formats, globs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pruning import rows_scanned
from ..sources.staging import made
from ..sources.table import OrcTable, csv_to_orc, write_orc
from .registry import query


def parquet(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_converted(spark: SparkSession, d: str) -> DataFrame:
    """A text file with a declared schema becomes ORC."""
    columns = [("c_custkey", "INT8"), ("c_name", "TEXT"), ("c_nationkey", "INT"), ("c_acctbal", "FLOAT8"), ("c_mktsegment", "TEXT")]
    text = made(spark, ("csv", d), lambda: parquet(spark, d, "customer"), write=lambda rows, path: rows.write.option("header", "true").csv(path))
    path = made(spark, ("csv-orc", d), lambda: text, write=lambda source, path: csv_to_orc(spark, source, path, columns))
    return OrcTable(spark, "customer", columns, {"filename": path}).scan()


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def partitioned_folder(spark: SparkSession, d: str) -> DataFrame:
    """A folder for each value of a column; the filter prunes folders."""
    path = made(spark, ("partitioned", d), lambda: parquet(spark, d, "orders"), write=lambda rows, path: write_orc(rows, path, partition_by=["o_orderstatus"]))
    return spark.read.orc(path).where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("SELECT count(*) AS n, min(c_custkey) AS first, (SELECT count(*) FROM customer) > 1000 AS skipped FROM customer WHERE c_name = 'Customer#000000077'")
def bloom_filter(spark: SparkSession, d: str) -> DataFrame:
    """Row groups whose least and greatest names say nothing, as rows are in no order: only the bloom filter skips any (if there are several groups)."""
    rows = parquet(spark, d, "customer").withColumn("_h", F.xxhash64("c_custkey"))
    path = made(
        spark, ("bloom", d), lambda: rows.coalesce(1).sortWithinPartitions("_h").drop("_h"), stride=1000,
        write=lambda rows, path: write_orc(rows, path, stride=1000, **{"orc.bloom.filter.columns": "c_name", "orc.bloom.filter.fpp": "0.01"}),
    )
    table = OrcTable.of(spark, "customer", path)
    wanted = table.scan().where("c_name = 'Customer#000000077'")
    read, every = rows_scanned(wanted), table.count().first()["count"]
    return wanted.agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"), F.lit(read < every).alias("skipped"))


@query("SELECT s_suppkey, s_name, s_acctbal, 3 AS copies FROM supplier")
def other_formats(spark: SparkSession, d: str) -> DataFrame:
    """The same table as CSV, JSON and Parquet, each read back and written as ORC under one folder, read by a glob: every row is there three times."""
    rows = parquet(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")

    def write(rows: DataFrame, path: str) -> None:
        for form in ("csv", "json", "parquet"):
            rows.write.format(form).save(f"{path}/{form}")
            write_orc(spark.read.schema(rows.schema).format(form).load(f"{path}/{form}"), f"{path}/orc-{form}")

    path = made(spark, ("formats", d), lambda: rows, write=write)
    columns = [("s_suppkey", "INT8"), ("s_name", "TEXT"), ("s_acctbal", "FLOAT8")]
    found = OrcTable(spark, "supplier", columns, {"filename": f"{path}/orc-*"}).scan()
    return found.groupBy("s_suppkey", "s_name", "s_acctbal").agg(F.count("*").cast("int").alias("copies"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def first_version(spark: SparkSession, d: str) -> DataFrame:
    """A file of the first version (run lengths of version 1, dictionaries of version 1), read as strictly as its option asks."""
    path = made(spark, ("first", d), lambda: parquet(spark, d, "orders"), write=lambda rows, path: write_orc(rows, path, **{"orc.write.format": "0.11"}))
    table = OrcTable.of(spark, "orders", path)
    strict = OrcTable(spark, "orders", [(c, t.family) for c, t in table.columns], {"filename": path, "strict_version": "true"})
    return strict.scan(["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])


@query("SELECT o_custkey, [o_custkey, o_custkey + 1] AS items FROM orders WHERE o_custkey = 7")
def filter_array_constant(spark: SparkSession, d: str) -> DataFrame:
    """A list column compared with a constant list."""
    rows = parquet(spark, d, "orders")
    items = F.array("o_custkey", F.col("o_custkey") + 1).alias("items")
    path = made(spark, ("pairs", d), lambda: rows.select("o_custkey", items))
    return OrcTable(spark, "pairs", [("o_custkey", "INT8"), ("items", "INT8[]")], {"filename": path}).scan().where("items = array(CAST(7 AS BIGINT), CAST(8 AS BIGINT))")
