"""Definitions, validation and values of declared tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from stripeline.plans.queries import BIGROW, bigrow, bigrow_rows
from stripeline.sources.footer import read_footer, read_strides
from stripeline.sources.table import OrcTable, Server, TableError, write_orc
from stripeline.sources.types import Declared


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    return write_orc(bigrow_rows(spark), f"file://{tmp_path_factory.mktemp('orc')}/bigrow.orc", stride=1000)


def table(spark, path, columns=BIGROW, **options):
    return OrcTable(spark, "t", columns, {"filename": path} | options)


def test_options(spark):
    with pytest.raises(TableError, match="filename is required"):
        OrcTable(spark, "t", [], {})
    with pytest.raises(TableError, match='invalid option "bad_option_name"') as e:
        OrcTable(spark, "t", [], {"filename": "x.orc", "bad_option_name": "1"})
    assert e.value.hint == "Valid options in this context are: filename"
    with pytest.raises(TableError, match="invalid option"):
        Server("s", {"filename": "x"})
    assert OrcTable(spark, "t", [], {"filename": "x"}, Server("s", {"drop_null_items": "false"})).options["drop_null_items"] == "false"
    assert OrcTable(spark, "t", [], {"filename": "x", "drop_null_items": "true"}, Server("s", {"drop_null_items": "false"})).options["drop_null_items"] == "true"


def test_missing_file_fails_at_scan_only(spark):
    t = table(spark, "file:///nowhere/missing_file.orc", [])
    with pytest.raises(TableError, match="Error opening file .*missing_file.orc"):
        t.scan()


def test_no_orc_file(spark, tmp_path):
    (tmp_path / "x.orc").write_bytes(b"plain text, no file of this kind" * 9)
    with pytest.raises(TableError, match="Error reading file"):
        table(spark, f"file://{tmp_path}/x.orc").scan()


@pytest.mark.parametrize(
    ("columns", "message"),
    [
        ([("type", "CHAR(6)")], "Error occurred while reading column 1: ORC and PSQL types do not match, ORC type is BOOLEAN"),
        (BIGROW[:-1], "Column count in table definition does not match with ORC file."),
        ([*BIGROW, ("more", "TEXT")], "Table definition has more columns than the ORC file"),
        ([*BIGROW[:2], ("integer1", "INT2"), *BIGROW[3:], ("more", "TEXT")], "Error occurred while reading column 3: ORC and PSQL types do not match, ORC type is INT"),
        ([*BIGROW[:4], ("list1", "TEXT[]"), *BIGROW[5:]], r"column 5: .* ORC type is INT\[\]"),
        ([*BIGROW[:4], ("list1", "INT"), *BIGROW[5:]], r"column 5: .* ORC type is INT\[\]"),
        ([*BIGROW[:5], ("float1", "INT"), *BIGROW[6:]], "column 7: .* ORC type is FLOAT"),  # a list takes two type ids
        ([*BIGROW[:10], ("timestamp1", "TIMESTAMPTZ")], "ORC type is TIMESTAMP"),
        ([*BIGROW[:10], ("timestamp1", "NUMERIC(10,2)")], "ORC type is TIMESTAMP"),
    ],
)
def test_definition_errors(spark, big, columns, message):
    with pytest.raises(TableError, match=message):
        table(spark, big, columns).scan()


def test_only_selected_columns_are_checked(spark, big):
    t = table(spark, big, [*BIGROW[:2], ("integer1", "INT2"), *BIGROW[3:]])
    assert t.scan(["short1"]).count() == 2000
    with pytest.raises(TableError, match="column 3"):
        t.scan(["integer1"])
    with pytest.raises(TableError, match="does not exist"):
        t.scan(["nope"])


def test_bigrow(spark, big):
    rows = table(spark, big).scan()
    assert dict(rows.dtypes)["timestamp1"] == "timestamp_ntz"
    assert rows.where("long1 = 500").collect() == bigrow_rows(spark).where("long1 = 500").collect()
    r = rows.where("long1 = 500").first()
    assert (r.list1, r.list2, r.double1, r.date1, r.timestamp1) == ([5000, 10000], ["item_500", "data_500"], -500.0, datetime.date(2014, 5, 16), datetime.datetime(2014, 5, 16, 2))
    assert [x.long1 for x in rows.where("string1 = 'string_7'").orderBy("long1").collect()] == list(range(7, 2000, 100))
    month = rows.where("date1 >= date'2018-01-01' AND date1 <= date'2018-01-01' + interval 1 month").orderBy("date1").limit(10)
    assert [x.long1 for x in month.collect()] == list(range(1826, 1836))
    assert rows.where("short1 > 10000").count() == 0 and table(spark, big).count().first()["count"] == 2000


def test_widening_and_names(spark, big):
    t = table(spark, big, [("a", "BOOL"), ("b", "INT8"), ("c", "INT8"), ("d", "INT8"), ("e", "INT8[]"), ("f", "FLOAT8"), ("g", "FLOAT4"), *[(f"x{k}", ty) for k, (_, ty) in enumerate(BIGROW[7:])]])
    rows = t.scan()
    assert dict(rows.dtypes)["b"] == "bigint" and dict(rows.dtypes)["e"] == "array<bigint>" and dict(rows.dtypes)["g"] == "float"
    assert rows.where("b = 7").first().d == 7


def test_unsupported_kinds(spark, tmp_path):
    for k, (expr, message) in enumerate({"named_struct('x', id)": "STRUCT kind", "map(id, id)": "MAP kind", "array(array(id))": "Only lists of primitive types", "cast(id as decimal(10,2))": "not supported type: DECIMAL"}.items()):
        path = write_orc(spark.range(3).selectExpr("id", f"{expr} AS other"), f"file://{tmp_path}/{k}")
        with pytest.raises(TableError, match=message):
            OrcTable(spark, "t", [("id", "INT8"), ("other", "TEXT")], {"filename": path}).scan(["id"])
    path = write_orc(spark.range(3).selectExpr("id", "cast('x' as binary) AS b", "cast(1 as tinyint) AS y"), f"file://{tmp_path}/binary")
    t = OrcTable(spark, "t", [("id", "INT8"), ("b", "BYTEA"), ("y", "INT2")], {"filename": path})
    assert t.scan(["id"]).count() == 3
    for c, kind in (("b", "BINARY"), ("y", "BYTE")):
        with pytest.raises(TableError, match=f"ORC type is {kind}"):
            t.scan([c])


def test_null_items(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1, array(1, NULL, 2)), (2, array()), (3, NULL), (4, array(CAST(NULL AS INT))) AS t(k, l)")
    path = write_orc(rows, f"file://{tmp_path}/l")
    columns = [("k", "INT"), ("l", "INT[]")]
    own = lambda **o: {r.k: r.l for r in table(spark, path, columns, **o).scan().collect()}
    assert own() == {1: [1, 2], 2: [], 3: None, 4: []}
    assert own(drop_null_items="false") == {1: [1, None, 2], 2: [], 3: None, 4: [None]}


def test_char_and_varchar(spark, tmp_path):
    path = write_orc(spark.sql("SELECT * FROM VALUES (1, 'ab'), (2, 'abc'), (3, 'abc   '), (4, NULL) AS t(k, s)"), f"file://{tmp_path}/c")
    rows = {r.k: r.s for r in table(spark, path, [("k", "INT"), ("s", "CHAR(3)")]).scan().collect()}
    assert rows == {1: "ab ", 2: "abc", 3: "abc", 4: None}
    assert {r.k: r.s for r in table(spark, path, [("k", "INT"), ("s", "VARCHAR(4)")]).scan().collect()} == {1: "ab", 2: "abc", 3: "abc ", 4: None}
    with pytest.raises(Exception, match=r"value too long for type character\(2\)"):
        table(spark, path, [("k", "INT"), ("s", "CHAR(2)")]).scan().collect()
    assert table(spark, path, [("k", "INT"), ("s", "CHAR(2)")]).scan(["k"]).count() == 4
    got = table(spark, path, [("k", "INT"), ("s", "CHAR(6)")]).where_char_equal("s", "abc").collect()
    assert sorted(r.k for r in got) == [2, 3]


def test_timestamps_keep_their_wall_clock(spark, tmp_path):
    """Not in the last second before 1970, which the ORC library itself reads a second late."""
    times = [datetime.datetime(1969, 12, 31, 23, 59, 57, 999999), datetime.datetime(1955, 3, 1, 5), datetime.datetime(2014, 6, 1, 12, 0, 0, 123456), datetime.datetime(2030, 1, 1)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(times)], "k int, t timestamp_ntz")
    path = write_orc(rows, f"file://{tmp_path}/t")
    assert [r.t for r in table(spark, path, [("k", "INT"), ("t", "TIMESTAMP")]).scan().orderBy("k").collect()] == times


@pytest.mark.parametrize("codec", ["none", "zlib", "snappy", "zstd", "lz4"])
def test_codecs_and_footer(spark, tmp_path, codec):
    path = write_orc(bigrow_rows(spark), f"file://{tmp_path}/x", codec, 1000)
    t = table(spark, path)
    meta = t.meta()
    assert meta.codec == codec.upper() and meta.rows == 2000 and meta.stride == 1000 and [c.kind for c in meta.columns][4] == "LIST" and meta.stripes[0].rows == 2000
    assert t.scan().agg(F.sum("long1")).first()[0] == 1999000


def test_strict_version(spark, tmp_path):
    path = write_orc(spark.range(3).select(F.col("id")), f"file://{tmp_path}/new")
    with pytest.raises(TableError, match="Unsupported file version 0.12"):
        table(spark, path, [("id", "INT8")], strict_version="true").scan()
    old = write_orc(spark.range(3).select(F.col("id")), f"file://{tmp_path}/old", **{"orc.write.format": "0.11"})
    assert table(spark, old, [("id", "INT8")], strict_version="true").scan().count() == 3


def test_strides(spark, big):
    strides = [s for f, _ in table(spark, big).files() for s in read_strides(spark, f)]
    assert [(s.first_row, s.rows) for s in strides] == [(0, 1000), (1000, 1000)]
    assert strides[1].bounds["long1"] == (1000, 1999) and strides[0].bounds["string1"] == ("string_0", "string_99")
    assert "boolean1" not in strides[0].bounds and "timestamp1" not in strides[0].bounds and "list1" not in strides[0].bounds
    assert read_footer(spark, table(spark, big).files()[0][0]).version == "0.12"


def test_views_catalog_and_file_definition(spark, big):
    table(spark, big).register("big_view")
    assert spark.sql("SELECT count(*) AS n FROM big_view WHERE integer1 >= 1990").first().n == 10
    spark.sql("DROP TABLE IF EXISTS big_catalog")
    table(spark, big).create("big_catalog")
    spark.sql("ANALYZE TABLE big_catalog COMPUTE STATISTICS FOR COLUMNS long1, string1")
    assert spark.table("big_catalog").count() == 2000
    spark.sql("DROP TABLE big_catalog")
    assert [c for c, _ in OrcTable.of(spark, "t", big).columns] == [c for c, _ in BIGROW]
    assert bigrow(spark).scan().count() == 2000


def test_declared_types():
    assert Declared.parse("char(10) not null") == Declared("char", 10) and Declared.parse("CHAR(10)[]") == Declared("char", 10, True)
    assert Declared.parse("double precision").family == "float8" and Declared.parse("CHAR").size == 1
    with pytest.raises(ValueError, match="unknown column type"):
        Declared.parse("POINT")


def test_rounded_average(spark):
    from stripeline.functions.scalar import rounded_average

    rows = spark.createDataFrame([(1, 1), (1, 2), (2, -1), (2, -2), (3, 0), (4, None), (5, 5), (5, None), *[(6, 29)] * 87, *[(6, 30)] * 40], "k int, v int")
    got = dict(map(tuple, rows.groupBy("k").agg(rounded_average(F.col("v"), 0).alias("a")).collect()))
    assert got == {1: 2.0, 2: -2.0, 3: 0.0, 4: None, 5: 5.0, 6: 29.0}
    assert rows.where("k = 6").agg(rounded_average(F.col("v")).alias("a")).first().a == 29.31  # 29.31496


def test_every_file_is_held_to_the_first(spark, tmp_path):
    """A second file of other types, order or number of columns, in a folder that is read as one table."""
    columns = [("id", "INT8"), ("s", "TEXT")]
    for k, (rows, fits) in enumerate({"id, cast(id AS string) AS s": True, "cast(id AS int) AS id, cast(id AS string) AS s": False, "cast(id AS string) AS s, id": False, "id": False, "id, cast(id AS string) AS s, id AS more": False}.items()):
        folder = f"file://{tmp_path}/{k}"
        write_orc(spark.range(3).selectExpr("id", "cast(id AS string) AS s").coalesce(1), f"{folder}/a")
        write_orc(spark.range(3).selectExpr(*rows.split(", ")).coalesce(1), f"{folder}/b")
        t = OrcTable(spark, "t", columns, {"filename": f"{folder}/*"})
        if fits:
            assert t.scan().count() == 6
        else:
            with pytest.raises(TableError, match="its columns aren't those of"):
                t.scan()


def test_many_files_are_compared_in_tasks(spark, tmp_path, monkeypatch):
    from stripeline.sources import footer

    monkeypatch.setattr(footer, "FEW_FILES", 1)
    folder = f"file://{tmp_path}/x"
    for k, kind in enumerate(("bigint", "bigint", "string")):
        files = [(p, n) for p, n in footer.data_files(spark, folder)]
        assert footer.odd_file(spark, files) is None
        write_orc(spark.range(3).selectExpr(f"cast(id AS {kind}) AS id").coalesce(1), f"{folder}/{k}")
    assert footer.odd_file(spark, footer.data_files(spark, folder)) is not None


def test_shared_folder_has_to_be_set_on_a_cluster():
    from types import SimpleNamespace

    from stripeline.session import shared_dir

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getConf=lambda: {})
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf={}, sparkContext=context))


def test_text_that_does_not_fit(spark, tmp_path):
    from stripeline.sources.table import csv_to_orc

    (tmp_path / "x.csv").write_text("id,s\n1,a\nnope,b\n")
    with pytest.raises(Exception, match="nope"):
        csv_to_orc(spark, f"file://{tmp_path}/x.csv", f"file://{tmp_path}/out", [("id", "INT8"), ("s", "TEXT")])
    path = csv_to_orc(spark, f"file://{tmp_path}/x.csv", f"file://{tmp_path}/lenient", [("id", "INT8"), ("s", "TEXT")], mode="DROPMALFORMED")
    assert [tuple(r) for r in OrcTable(spark, "t", [("id", "INT8"), ("s", "TEXT")], {"filename": path}).scan().collect()] == [(1, "a")]


def test_partitioned_folders_are_pruned(spark, tmp_path):
    path = write_orc(spark.range(30).selectExpr("id", "id % 3 AS part"), f"file://{tmp_path}/p", partition_by=["part"])
    rows = spark.read.orc(path).where("part = 1")
    assert rows.count() == 10 and "PartitionFilters: [isnotnull(part" in rows._jdf.queryExecution().toString()
