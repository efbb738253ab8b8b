import os

from pyspark.sql import functions as F

from stripeline.llm import common


def test_staged_tables_are_removed(spark):
    rows = common.stage(spark.range(5), "some")
    path = common._staged[spark.sparkContext.applicationId][-1]
    assert rows.count() == 5 and os.path.isdir(path.removeprefix("file://"))
    kept, common._staged[spark.sparkContext.applicationId] = common._staged[spark.sparkContext.applicationId][:-1], [path]
    common.clear(spark)
    assert not os.path.exists(path.removeprefix("file://"))
    common._staged[spark.sparkContext.applicationId] = kept


def test_joins_of_hot_values(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"))
    one = rows.groupBy("k").agg(F.count("*").alias("n"))
    for few in (False, True):
        got = common.join_by(rows, one, ["k"], F.col("n") > 10, few).collect()
        assert sorted((r.id, r.k, r.n) for r in got) == [(i, 0 if i < 2000 else i, 2000 if i < 2000 else 1) for i in range(3000)]
