"""The engine's queries over ORC-staged tables, each with the same query in DuckDB's SQL over the Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import bucket_of, month_of, rendered, rounded_average
from ..functions.values import compacted
from ..sources.staging import made, orc_table, staged
from ..sources.table import OrcTable
from .registry import oracle_sql, queries, query, scan, simple, sql

__all__ = ["oracle_sql", "queries"]

# Scans, projections, counts

simple("scan_all_orders", "orders", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders", lambda t: t.select("*"))
for _t, _cols in {
    "region": "r_regionkey, r_name", "nation": "n_nationkey, n_name, n_regionkey", "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal", "part": "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice", "events": "event_id, ts, user_id, event_type, value, props",
}.items():
    simple(f"scan_{_t}", _t, f"SELECT {_cols} FROM {_t}", lambda t: t)
simple("project_lineitem", "lineitem", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem", lambda t: t.select("l_orderkey", "l_linenumber", "l_extendedprice"))
query("SELECT count(*) AS count FROM lineitem", "count_star_lineitem")(lambda spark, d: orc_table(spark, d, "lineitem").count())
simple("count_col_events", "events", "SELECT count(value) AS n FROM events", lambda t: t.agg(F.count("value").alias("n")))

# Predicates

for _n, _p in {"eq_int": "l_linenumber = 3", "ne": "l_linenumber <> 1", "lt": "l_orderkey < 500", "gt": "l_orderkey > 1000", "le": "l_quantity <= 5", "ge": "l_quantity >= 45", "const_left": "1500 > l_orderkey"}.items():
    sql(f"filter_{_n}", f"SELECT l_orderkey, l_linenumber, l_quantity FROM {{lineitem}} WHERE {_p}")
sql("filter_eq_string", "SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderpriority = '1-URGENT'")
sql("filter_eq_long", "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderkey = 500")
sql(
    "filter_date_interval",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM {orders} WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate <= DATE '1996-01-01' + INTERVAL 1 MONTH",
)
sql("filter_empty", "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderkey < -1")
sql("filter_expr_not_pushed", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_linenumber + 1 = 5")
sql("filter_column_column", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_discount = l_tax")
sql("filter_or", "SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderstatus = 'F' OR o_totalprice > 300000")
sql("filter_not", "SELECT o_orderkey FROM {orders} WHERE NOT (o_orderstatus = 'F')")
sql("filter_in", "SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
sql("filter_between", "SELECT l_orderkey, l_quantity FROM {lineitem} WHERE l_quantity BETWEEN 10 AND 12")
sql("filter_like", "SELECT c_custkey, c_name FROM {customer} WHERE c_name LIKE '%7'")
sql(
    "filter_is_null",
    "SELECT e.event_id, u.c_custkey FROM {events} e LEFT JOIN {customer} u ON u.c_custkey = e.user_id + 10 AND u.c_acctbal > 5000 WHERE u.c_custkey IS NULL",
)
sql("filter_is_not_null", "SELECT event_id, value FROM {events} WHERE value IS NOT NULL")

# Aggregation. Averages are exact decimals, rounded half up; DuckDB averages as doubles, so its side rounds in whole numbers.

query(
    "SELECT CAST(extract(month FROM o_orderdate) AS BIGINT) AS review_month, CAST((200 * sum(CAST(floor(o_totalprice) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average, count(*) AS n FROM orders GROUP BY 1",
    "rating_by_month",
)(
    lambda spark, d: scan(spark, d, "orders", ["o_totalprice", "o_orderdate"])
    .groupBy(month_of(F.col("o_orderdate")).alias("review_month")).agg(rounded_average(F.floor("o_totalprice")).alias("average"), F.count("*").alias("n")).orderBy("review_month")
)
query(
    "SELECT CAST(CASE WHEN length(p_name) < 1 THEN 0 WHEN length(p_name) >= 50 THEN 6 ELSE floor((length(p_name) - 1) * 5.0 / 49) + 1 END AS BIGINT) AS title_length_bucket, CAST((200 * sum(p_size) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1",
    "title_len_bucket",
)(
    lambda spark, d: scan(spark, d, "part", ["p_name", "p_size"]).where("p_size > 10")
    .groupBy(bucket_of(F.length("p_name"), 1, 50, 5).alias("title_length_bucket")).agg(rounded_average(F.col("p_size")).alias("average"), F.count("*").alias("n")).orderBy("title_length_bucket")
)
query("SELECT p_brand, CAST((200 * sum(p_size) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average, count(*) AS n FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 20", "category_topk")(
    lambda spark, d: scan(spark, d, "part", ["p_brand", "p_size"]).groupBy("p_brand").agg(rounded_average(F.col("p_size")).alias("average"), F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(20)
)
sql(
    "group_min_max",
    """
    SELECT l_returnflag, l_linestatus, min(l_quantity) AS least, max(l_extendedprice) AS most, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM {lineitem}
    GROUP BY l_returnflag, l_linestatus
    """,
)
sql(
    "group_deviation",
    """
    SELECT p_brand, round(stddev_samp(p_size), 6) AS deviation, round(var_samp(p_size), 6) AS variance FROM {part} GROUP BY p_brand
    """,
)
sql("group_hashed", "SELECT l_suppkey, count(*) AS n, max(l_partkey) AS part FROM {lineitem} GROUP BY l_suppkey")
sql("group_sorted", "SELECT l_suppkey, min(l_returnflag) AS first, max(l_linestatus) AS last FROM {lineitem} GROUP BY l_suppkey")
sql("count_distinct", "SELECT count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM {lineitem}")
sql("select_distinct", "SELECT DISTINCT p_brand, p_size FROM {part}")
sql("having", "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) > 12")
sql("group_filtered", "SELECT l_returnflag, count(*) AS n FROM {lineitem} WHERE l_quantity > 25 GROUP BY l_returnflag")
sql("rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)")
sql("cube", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)")
sql("grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))")


@query("SELECT l_returnflag, true AS parts_near, true AS median_near, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def approximate(spark: SparkSession, d: str) -> DataFrame:
    """Approximate distinct values and quantiles beside the exact ones: within a tenth, and within a rank of a hundredth."""
    rows = scan(spark, d, "lineitem", ["l_returnflag", "l_partkey", "l_quantity"])
    low, high = (F.percentile("l_quantity", F.lit(q)) for q in (0.49, 0.51))
    median = F.percentile_approx("l_quantity", 0.5, 1000)
    return rows.groupBy("l_returnflag").agg(
        (F.abs(F.approx_count_distinct("l_partkey", 0.02) / F.count_distinct("l_partkey") - 1) < 0.1).alias("parts_near"), median.between(F.floor(low), F.ceil(high)).alias("median_near"), F.count("*").alias("n")
    )


@query("SELECT count(*) AS n, min(l_orderkey) AS least, max(l_orderkey) AS most FROM lineitem")
def aggregate_from_metadata(spark: SparkSession, d: str) -> DataFrame:
    """count, least and greatest from the files' own statistics: a session of its own reads ORC through the source that pushes aggregates down."""
    path = orc_table(spark, d, "lineitem").path
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "parquet,csv,json,text")
    own.conf.set("spark.sql.orc.aggregatePushdown", "true")
    return own.read.orc(path).agg(F.count("*").alias("n"), F.min("l_orderkey").alias("least"), F.max("l_orderkey").alias("most"))


# Joins

sql("join_inner", "SELECT o_orderkey, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey")
sql("join_left", "SELECT c_custkey, o_orderkey FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey AND o_totalprice > 200000")
sql("join_right", "SELECT o_orderkey, c_custkey FROM {orders} RIGHT JOIN {customer} ON o_custkey = c_custkey AND o_orderstatus = 'P'")
sql("join_full", "SELECT s_suppkey, n_name FROM {supplier} FULL JOIN {nation} ON s_nationkey = n_nationkey AND s_acctbal > 5000")
sql("join_semi", "SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
sql("join_anti", "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
sql("join_in", "SELECT s_suppkey FROM {supplier} WHERE s_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = 1)")
sql("join_theta", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM {nation} a JOIN {nation} b ON a.n_nationkey < b.n_nationkey")
sql("join_cross", "SELECT r_regionkey, n_nationkey FROM {region} CROSS JOIN {nation}")

#: A side is broadcast only if its files are no larger.
BROADCAST_BYTES = 10 << 20


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast(spark: SparkSession, d: str) -> DataFrame:
    """The small side is broadcast if its files' size allows it; else Spark chooses."""
    table = orc_table(spark, d, "nation")
    small = table.scan()
    if sum(size for _, size in table.files()) <= BROADCAST_BYTES:
        small = F.broadcast(small)
    customers = scan(spark, d, "customer", ["c_custkey", "c_nationkey"])
    return customers.join(small, customers.c_nationkey == small.n_nationkey).select("c_custkey", "n_name")


# Windows, sorting, sets, subqueries

sql(
    "window_rank",
    """
    SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS BIGINT) AS nth, CAST(rank() OVER (PARTITION BY p_brand
    ORDER BY p_size) AS BIGINT) AS rank, CAST(dense_rank() OVER (PARTITION BY p_brand
    ORDER BY p_size) AS BIGINT) AS dense, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS BIGINT) AS quarter FROM {part}
    """,
)
sql(
    "window_lag_lead",
    """
    SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, first_value(o_orderkey) OVER w AS first FROM {orders}
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
sql(
    "window_frame",
    """
    SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near, max(l_quantity) OVER (PARTITION BY l_orderkey) AS most FROM {lineitem}
    """,
)
sql(
    "window_last",
    """
    SELECT o_orderkey, last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last,
           last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS soon,
           nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second,
           percent_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS share, cume_dist() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS upto
    FROM {orders}
    """,
)
sql(
    "window_range",
    """
    SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near,
           max(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS most,
           min(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN CURRENT ROW AND 3 FOLLOWING) AS least
    FROM {part}
    """,
)
sql("order_by", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey")
sql("topk", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
sql("offset", "SELECT o_orderkey FROM {orders} ORDER BY o_orderkey LIMIT 10 OFFSET 25")
sql("union_all", "SELECT n_nationkey AS k FROM {nation} UNION ALL SELECT r_regionkey AS k FROM {region}")
sql("union_distinct", "SELECT n_regionkey AS k FROM {nation} UNION SELECT r_regionkey AS k FROM {region}")
sql("intersect", "SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey AS k FROM {supplier}")
sql("intersect_all", "SELECT c_nationkey AS k FROM {customer} INTERSECT ALL SELECT s_nationkey AS k FROM {supplier}")
sql("except", "SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey AS k FROM {orders} WHERE o_totalprice > 450000")
sql("except_all", "SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey AS k FROM {supplier}")
sql("cte", "WITH big AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey) SELECT n, count(*) AS customers FROM big GROUP BY n")
sql("subquery_scalar", "SELECT o_orderkey FROM {orders} WHERE o_totalprice = (SELECT max(o_totalprice) FROM {orders})")
sql("subquery_correlated", "SELECT p_partkey FROM {part} p WHERE p_size = (SELECT max(q.p_size) FROM {part} q WHERE q.p_brand = p.p_brand)")

# Values

query("SELECT c_custkey, rpad(c_mktsegment, 12, ' ') AS segment FROM customer", "char_pad")(
    lambda spark, d: OrcTable(spark, "customer", [("c_custkey", "INT8"), ("c_name", "TEXT"), ("c_nationkey", "INT"), ("c_acctbal", "FLOAT8"), ("segment", "CHAR(12)")], {"filename": staged(spark, d, "customer")}).scan(["c_custkey", "segment"])
)
query("SELECT c_custkey, rpad(c_mktsegment, 12, ' ') AS segment FROM customer WHERE c_mktsegment = 'BUILDING'", "char_equal")(
    lambda spark, d: OrcTable(spark, "customer", [("c_custkey", "INT8"), ("c_name", "TEXT"), ("c_nationkey", "INT"), ("c_acctbal", "FLOAT8"), ("segment", "CHAR(12)")], {"filename": staged(spark, d, "customer")}).where_char_equal("segment", "BUILDING").select("c_custkey", "segment")
)
query("SELECT c_custkey AS k, c_name AS a, CAST(c_nationkey AS BIGINT) AS b, c_acctbal AS c, c_mktsegment AS d FROM customer", "widen_and_rename")(
    lambda spark, d: OrcTable(spark, "renamed", [("k", "INT8"), ("a", "VARCHAR"), ("b", "INT8"), ("c", "FLOAT8"), ("d", "TEXT")], {"filename": staged(spark, d, "customer")}).scan()
)
simple("list_scan", "embeddings", "SELECT vec_id, embedding, label FROM embeddings", lambda t: t)
simple("list_subscript", "embeddings", "SELECT vec_id, embedding[1] AS first FROM embeddings", lambda t: t.select("vec_id", F.get("embedding", F.lit(0)).alias("first")))
simple("list_length", "embeddings", "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n FROM embeddings", lambda t: t.select("vec_id", F.size("embedding").cast("bigint").alias("n")))
simple("list_unnest", "embeddings", "SELECT vec_id, unnest(embedding) AS item FROM embeddings", lambda t: t.select("vec_id", F.explode("embedding").alias("item")))
simple("list_any", "embeddings", "SELECT vec_id, list_contains(embedding, embedding[3]) AS found FROM embeddings", lambda t: t.select("vec_id", F.array_contains("embedding", F.get("embedding", F.lit(2))).alias("found")))


@query("SELECT o_custkey, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE list_filter([o_custkey, CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_custkey + 1 END], lambda e: e IS NOT NULL) END AS items FROM orders")
def list_drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Lists with null items and null lists, written and read again."""
    rows = spark.read.parquet(f"{d}/orders.parquet")
    items = F.when(F.col("o_custkey") % 5 != 0, F.array("o_custkey", F.when(F.col("o_custkey") % 2 != 0, F.col("o_custkey") + 1)))
    path = made(spark, ("lists", d), lambda: rows.select("o_custkey", items.alias("items")))
    return OrcTable(spark, "lists", [("o_custkey", "INT8"), ("items", "INT8[]")], {"filename": path}).scan()


simple("list_rendered", "embeddings", "SELECT vec_id, '{' || CAST(label AS VARCHAR) || ',' || CAST(vec_id AS VARCHAR) || '}' AS text FROM embeddings", lambda t: t.select("vec_id", rendered(compacted(F.array(F.col("label").cast("bigint"), F.lit(None).cast("bigint"), F.col("vec_id")))).alias("text")))
simple("date_col", "orders", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders", lambda t: t.select("o_orderkey", F.to_date("o_orderdate").alias("day")))
simple("timestamp_wallclock", "events", "SELECT event_id, ts, CAST(extract(hour FROM ts) AS BIGINT) AS hour FROM events", lambda t: t.select("event_id", "ts", F.hour("ts").cast("bigint").alias("hour")))
for _codec in ("none", "zlib", "snappy", "zstd", "lz4"):
    simple(f"codec_{_codec}", "customer", "SELECT c_custkey, c_name, c_acctbal FROM customer", lambda t: t.select("c_custkey", "c_name", "c_acctbal"), codec=_codec)

# The type round trip: i is the row's number

BIGROW = [("boolean1", "BOOLEAN"), ("short1", "INT2"), ("integer1", "INT"), ("long1", "INT8"), ("list1", "INT[]"), ("float1", "FLOAT4"), ("double1", "FLOAT8"), ("string1", "VARCHAR"), ("list2", "VARCHAR[]"), ("date1", "DATE"), ("timestamp1", "TIMESTAMP")]
_BIGROW_SQL = (
    "(SELECT true AS boolean1, CAST(i AS SMALLINT) AS short1, CAST(i AS INT) AS integer1, i AS long1, [CAST(10 * i AS INT), CAST(20 * i AS INT)] AS list1, CAST(i AS FLOAT) AS float1, CAST(-i AS DOUBLE) AS double1, "
    "'string_' || CAST(i % 100 AS VARCHAR) AS string1, ['item_' || CAST(i AS VARCHAR), 'data_' || CAST(i AS VARCHAR)] AS list2, DATE '2013-01-01' + CAST(i AS INT) AS date1, "
    "CAST(DATE '2013-01-01' + CAST(i AS INT) AS TIMESTAMP) + INTERVAL 2 HOUR AS timestamp1 FROM range(2000) t(i))"
)


def bigrow_rows(spark: SparkSession, n: int = 2000) -> DataFrame:
    i = F.col("id")
    day = F.date_add(F.lit("2013-01-01").cast("date"), i.cast("int"))
    return spark.range(0, n, 1, 1).select(
        F.lit(True).alias("boolean1"), i.cast("smallint").alias("short1"), i.cast("int").alias("integer1"), i.alias("long1"), F.array((i * 10).cast("int"), (i * 20).cast("int")).alias("list1"),
        i.cast("float").alias("float1"), (-i).cast("double").alias("double1"), F.concat(F.lit("string_"), (i % 100).cast("string")).alias("string1"),
        F.array(F.concat(F.lit("item_"), i.cast("string")), F.concat(F.lit("data_"), i.cast("string"))).alias("list2"), day.alias("date1"), (day.cast("timestamp_ntz") + F.expr("INTERVAL 2 HOURS")).alias("timestamp1"),
    )


def bigrow(spark: SparkSession) -> OrcTable:
    return OrcTable(spark, "bigrow", BIGROW, {"filename": made(spark, ("bigrow",), lambda: bigrow_rows(spark), stride=1000)})


for _n, _what, _oracle in (
    ("count", "SELECT count(*) AS n FROM {bigrow}", None), ("count_short", "SELECT count(short1) AS n FROM {bigrow}", None), ("short_none", "SELECT * FROM {bigrow} WHERE short1 > 10000", None),
    ("int_none", "SELECT * FROM {bigrow} WHERE integer1 < 0", None), ("long_one", "SELECT * FROM {bigrow} WHERE long1 = 500", None), ("string_twenty", "SELECT * FROM {bigrow} WHERE string1 = 'string_7'", None),
    ("month", "SELECT * FROM {bigrow} WHERE date1 >= DATE '2018-01-01' AND date1 <= DATE '2018-01-01' + INTERVAL 1 MONTH ORDER BY date1 LIMIT 10", None),
):
    query(_what.replace("{bigrow}", _BIGROW_SQL + " b"), f"bigrow_{_n}")(lambda spark, d, text=_what: spark.sql(text, bigrow=bigrow(spark).scan()))

from . import files, metadata, scalars, streams  # noqa: E402, F401  (they register their queries)
