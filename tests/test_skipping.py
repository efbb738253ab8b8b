"""Row-group skipping: the report, what scans read, and that skipping never changes results."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stripeline.operators.analyze import analyze, column_statistics, estimate, pages_of, sample
from stripeline.operators.pruning import Predicate, rows_scanned, stride_report
from stripeline.plans.explain import explain_properties, pushed_filters, read_schemas
from stripeline.sources.table import OrcTable, write_orc

N, STRIDE = 20_000, 1000


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    rows = spark.range(0, N, 1, 1).select(
        F.col("id").cast("int").alias("i"), (F.col("id") + 3_000_000_000).alias("l"), F.col("id").cast("double").alias("d"), F.format_string("s%06d", "id").alias("s"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.when(F.col("id") >= 1000, F.col("id").cast("int")).alias("nul"), F.col("id").cast("float").alias("f"),
    )
    path = write_orc(rows, f"file://{tmp_path_factory.mktemp('skip')}/n", stride=STRIDE)
    columns = [("i", "INT8"), ("l", "INT8"), ("d", "FLOAT8"), ("s", "TEXT"), ("day", "DATE"), ("nul", "INT"), ("f", "FLOAT8")]
    return OrcTable(spark, "numbers", columns, {"filename": path})


@pytest.mark.parametrize(
    ("predicate", "wanted", "read"),
    [
        ("i = 500", 1, 1000), ("i > 15000", 4999, 5000), ("i < 0", 0, 0), ("500 = i", 1, 1000), ("l = 3000000070", 1, 1000), ("d >= 19500", 500, 1000), ("s = 's000700'", 1, 1000),
        ("day >= date'2000-01-01' AND day <= date'2000-01-01' + interval 1 month", 32, 1000), ("nul = 5", 0, 0), ("f = 7", 1, 1000), ("i = 5 OR i = 19999", 2, 2000), ("i IN (3, 4)", 2, 1000), ("i + 1 = 5", 1, N),
    ],
)
def test_scans_read_what_they_need(numbers, predicate, wanted, read):
    rows = numbers.scan().where(predicate)
    assert rows.count() == wanted and rows_scanned(rows) == read


def test_pushdown_off_reads_all(spark, numbers):
    spark.conf.set("spark.sql.orc.filterPushdown", "false")
    try:
        assert rows_scanned(numbers.scan().where("i = 500")) == N
    finally:
        spark.conf.unset("spark.sql.orc.filterPushdown")


def test_report_agrees_with_scan(numbers):
    for p in (Predicate("i", "=", 500), Predicate("i", "<", 2500), Predicate("l", ">", 3_000_018_500), Predicate("s", ">=", "s019000"), Predicate("day", "<=", datetime.date(2000, 3, 1)), Predicate.turned(500, ">=", "i"), Predicate("nul", "=", 5)):
        kept = stride_report(numbers, [p]).where("kept").agg(F.sum("rows")).first()[0] or 0
        assert kept == rows_scanned(numbers.scan().where(p.condition())), p
    both = stride_report(numbers, [Predicate("i", ">", 4000), Predicate("i", "<", 6000)]).where("kept").count()
    assert both == 2
    assert stride_report(numbers, [Predicate("i", "<>", 3)]).where("kept").count() == 20
    with pytest.raises(ValueError, match="can't be pushed"):
        Predicate("i", "~", 1)


def test_skipping_changes_no_result(spark, tmp_path):
    rng = random.Random(12)
    rows = [(rng.choice([None, rng.randint(-50, 50)]), rng.choice([None, rng.uniform(-5, 5)]), rng.choice([None, "", "a", "zz"])) for _ in range(3000)]
    plain = spark.createDataFrame(rows, "a int, b double, c string")
    t = OrcTable(spark, "r", [("x", "INT8"), ("y", "FLOAT8"), ("z", "TEXT")], {"filename": write_orc(plain.repartition(3), f"file://{tmp_path}/r", stride=1000)})
    for _ in range(12):
        conditions = [rng.choice([f"x {rng.choice(['=', '<', '>', '<=', '>=', '<>'])} {rng.randint(-60, 60)}", f"y {rng.choice(['<', '>'])} {rng.uniform(-5, 5):.2f}", f"z {rng.choice(['=', '<', '>='])} '{rng.choice(['', 'a', 'm'])}'", "x IS NULL"]) for _ in range(rng.randint(1, 3))]
        where = " AND ".join(conditions)
        assert t.scan().where(where).count() == plain.toDF("x", "y", "z").where(where).count(), where


def test_without_index(spark, tmp_path):
    path = write_orc(spark.range(3000), f"file://{tmp_path}/plain", **{"orc.create.index": "false"})
    t = OrcTable(spark, "p", [("id", "INT8")], {"filename": path})
    assert t.scan().where("id = 5").count() == 1
    assert stride_report(t, [Predicate("id", "=", 5)]).where("kept").count() >= 1


def test_plans(numbers):
    rows = numbers.scan().where("i = 500").select("s")
    assert any("EqualTo(i,500)" in f for f in pushed_filters(rows)) and read_schemas(rows) == ["struct<i:int,s:string>"]
    assert "ReadSchema: struct<>" in numbers.count()._jdf.queryExecution().toString() or read_schemas(numbers.count()) == ["struct<>"]
    assert explain_properties(numbers)["Orc File"] == numbers.path and int(explain_properties(numbers)["Orc File Size"]) > 0
    assert "Orc File Size" not in explain_properties(numbers, costs=False)


def test_analysis(numbers):
    rows, total, dead = analyze(numbers, 500, seed=3)
    assert (rows.count(), total, dead) == (500, N, 0) and rows.select("i").distinct().count() == 500
    assert sample(numbers.scan(), N * 2).count() == N
    stats = {r.column: r for r in column_statistics(numbers.scan()).collect()}
    assert stats["i"].least == "0" and stats["i"].greatest == str(N - 1) and abs(stats["nul"].null_share - 0.05) < 1e-9 and abs(stats["s"].distinct / N - 1) < 0.2
    e = estimate(numbers, analyzed=(pages_of(numbers), N))
    assert e.rows == N and e.total_cost == pages_of(numbers) + 0.1 * N
    missing = OrcTable(numbers.spark, "m", [("a", "INT8")], {"filename": "file:///nowhere/x.orc"})
    assert pages_of(missing) == 10 and estimate(missing).rows == round(81920 / 32)


def test_stream(spark, tmp_path):
    from stripeline.streaming import late_tolerant_counts

    rows = spark.sql("SELECT id, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT), 0) AS t, CAST(id % 2 AS STRING) AS k FROM range(20)")
    path = write_orc(rows, f"file://{tmp_path}/in")
    t = OrcTable(spark, "s", [("n", "INT8"), ("at", "TIMESTAMP"), ("key", "TEXT")], {"filename": path})
    q = late_tolerant_counts(t.stream(), "at", ["key"], "10 minutes", "1 minute").writeStream.outputMode("complete").format("memory").queryName("counts").start()
    try:
        q.processAllAvailable()
        assert sorted(r["rows"] for r in spark.table("counts").collect()) == [5, 5, 5, 5]
    finally:
        q.stop()


def test_aggregates_from_statistics(spark, sf):
    from stripeline.plans.queries import aggregate_from_metadata

    plan = aggregate_from_metadata(spark, sf)._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plan


def test_reports_of_many_files_name_some(numbers, monkeypatch):
    from stripeline.operators import pruning

    monkeypatch.setattr(pruning, "MOST_FILES", 0)
    with pytest.raises(ValueError, match="at most"):
        stride_report(numbers, [Predicate("i", "=", 500)])
    monkeypatch.undo()
    first = numbers.files()[0][0]
    assert stride_report(numbers, [Predicate("i", "=", 500)], [first]).count() == 20


def test_late_rows_and_sliding_windows(spark, tmp_path):
    """Files one by one: rows older than the watermark are left out, sessions are closed by it."""
    from stripeline.streaming import finished, late_tolerant_counts, running_totals, sessions

    def put(k, *minutes):
        rows = spark.createDataFrame([(m, f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00") for m in minutes], "n long, t string").selectExpr("n", "CAST(t AS TIMESTAMP_NTZ) AS t")
        write_orc(rows.coalesce(1), f"file://{tmp_path}/in/{k}")

    put(0, 5, 8, 20)
    put(1, 300, 305)
    put(2, 301)
    put(3, 9)  # over an hour late when the watermark of two files before is known
    t = OrcTable(spark, "s", [("n", "INT8"), ("at", "TIMESTAMP")], {"filename": f"file://{tmp_path}/in/*"})
    stream = lambda: t.stream(["n", "at"], maxFilesPerTrigger="1")
    minute = lambda r: r.start.hour * 60 + r.start.minute
    last = {}
    for r in sorted(finished(late_tolerant_counts(stream(), "at", [], "10 minutes", "1 hour", "5 minutes"), "slide", "update").collect(), key=lambda r: r._batch):
        last[minute(r)] = r["rows"]
    assert last == {0: 2, 5: 2, 15: 1, 20: 1, 295: 2, 300: 3, 305: 1}
    whole = finished(late_tolerant_counts(stream(), "at", [], "10 minutes", "1 hour", "5 minutes"), "slide")
    assert {minute(r): r["rows"] for r in whole.collect()} == last | {0: 3, 5: 3}  # the complete result keeps all state, so nothing is late
    closed = finished(sessions(stream().selectExpr("at", "'x' AS k"), "at", ["k"], "10 minutes", "1 hour"), "sess", "append")
    assert sorted((minute(r), r["rows"]) for r in closed.collect()) == [(5, 2), (20, 1)]
    totals = finished(running_totals(stream().selectExpr("n % 2 AS k", "n"), "k", "n"), "tot", "update").collect()
    last = {r.k: max((x for x in totals if x.k == r.k), key=lambda x: x._batch) for r in totals}
    assert (last[0]["rows"], last[1]["rows"]) == (3, 4) and last[0].most == 300


@pytest.mark.parametrize("stripes", [1, 2])
def test_ordered_row_groups_run_over_files(spark, tmp_path, stripes):
    from stripeline.sources.staging import write_ordered

    rows = spark.range(300_500).select(F.when(F.col("id") < 299_000, F.col("id")).alias("k")).repartition(7)
    t = OrcTable(spark, "o", [("k", "INT8")], {"filename": write_ordered(rows, f"file://{tmp_path}/o", "k", 1000, stripes)})
    assert len(t.files()) == (3 if stripes == 1 else 2) and not (tmp_path / "o-parts").exists()
    report = stride_report(t, [Predicate("k", ">=", 127_500), Predicate("k", "<", 129_000)])
    assert {(r.kept, r.empty): (r["count"], r.n) for r in report.groupBy("kept", "empty").agg(F.count("*").alias("count"), F.sum("rows").alias("n")).collect()} == {
        (True, False): (2, 2000), (False, False): (297, 297_000), (False, True): (2, 1500),
    }
    assert t.scan().agg(F.count("*"), F.sum("k")).first() == (300_500, 298_999 * 299_000 // 2)


@pytest.mark.parametrize("name", ["stride_skip_report", "skip_all_scanned"])
def test_row_groups_of_many_unordered_files(spark, sf, tmp_path, name):
    """Files of no whole thousands of rows, in no order, and keys that are null."""
    import duckdb

    from stripeline.plans import queries as engine

    orders = spark.read.parquet(f"{sf}/orders.parquet")
    keys = spark.range(5).withColumnRenamed("id", "copy")
    key = F.when(F.col("copy") < 4, F.col("o_orderkey") + 1500 * F.col("copy")).alias("o_orderkey")
    orders.crossJoin(keys).select(key, *orders.columns[1:]).repartition(7, F.rand(3)).write.parquet(f"file://{tmp_path}/orders.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    got, want = engine.queries()[name](spark, f"file://{tmp_path}"), duck.sql(engine.oracle_sql()[name])
    assert sorted(map(repr, (tuple(r[c] for c in want.columns) for r in got.collect()))) == sorted(map(repr, want.fetchall()))
