"""Scalar functions over declared tables: strings, patterns, dates, numbers, conditions and casts, JSON; and the functions that users register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.registered import register
from .registry import query, scan, sql

sql(
    "string_functions",
    """
    SELECT c_custkey, upper(c_name) AS upper, lower(c_mktsegment) AS lower, substring(c_name, 3, 5) AS part, left(c_name, 4) AS first,
           right(c_name, 4) AS last, trim(concat('  ', c_mktsegment, ' ')) AS trimmed, ltrim(concat('  ', c_name)) AS begun,
           rtrim(concat(c_name, '  ')) AS ended, concat(c_name, '-', c_mktsegment) AS joined, concat_ws('/', c_name, NULL, c_mktsegment) AS listed,
           replace(c_name, 'Customer', 'C') AS replaced, translate(c_name, 'Cus', 'kUz') AS translated, reverse(c_mktsegment) AS backward,
           repeat(left(c_name, 2), 3) AS repeated, lpad(c_mktsegment, 12, '.') AS padded, split_part(c_name, '#', 2) AS number,
           CAST(position('er' IN c_name) AS BIGINT) AS place, CAST(length(c_name) AS BIGINT) AS n, CAST(ascii(c_name) AS BIGINT) AS code, md5(c_name) AS digest
    FROM {customer}
    """,
)
sql("like_escape", "SELECT c_custkey, c_name LIKE '%#0000%' AS zeros, c_name NOT LIKE '_ustomer%' AS other, lower(c_mktsegment) LIKE 'b%g' AS bg FROM {customer}")
sql(
    "regex_functions",
    r"""
    SELECT c_custkey, c_name RLIKE '^Customer#0*[1-9]7$' AS found, regexp_replace(c_name, '[0-9]+', 'N') AS replaced,
           regexp_extract(c_name, '([A-Za-z]+)#0*([0-9]+)', 2) AS number, CAST(regexp_count(c_name, '0') AS BIGINT) AS zeros,
           regexp_extract_all(c_name, '[1-9]', 0) AS digits
    FROM {customer}
    """,
    r"""
    SELECT c_custkey, regexp_matches(c_name, '^Customer#0*[1-9]7$') AS found, regexp_replace(c_name, '[0-9]+', 'N', 'g') AS replaced,
           regexp_extract(c_name, '([A-Za-z]+)#0*([0-9]+)', 2) AS number, CAST(len(regexp_extract_all(c_name, '0')) AS BIGINT) AS zeros,
           regexp_extract_all(c_name, '[1-9]') AS digits
    FROM customer
    """,
)
_DATES = """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
           CAST(extract(YEAR FROM o_orderdate) AS BIGINT) AS year, CAST(extract(QUARTER FROM o_orderdate) AS BIGINT) AS quarter,
           CAST(extract(DAY FROM o_orderdate) AS BIGINT) AS day, CAST(extract(DOY FROM o_orderdate) AS BIGINT) AS day_of_year,
           CAST(extract(WEEK FROM o_orderdate) AS BIGINT) AS week, {weekday} AS weekday, {days} AS days,
           last_day(CAST(o_orderdate AS DATE)) AS last, make_date(1995, 3, 2) AS made,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS later, CAST(CAST(o_orderdate AS DATE) - INTERVAL 10 DAY AS DATE) AS before
    FROM {orders}
    """
sql(
    "date_functions",
    _DATES.replace("{weekday}", "CAST(extract(DOW_ISO FROM o_orderdate) AS BIGINT)").replace("{days}", "CAST(datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01') AS BIGINT)"),
    _DATES.replace("{weekday}", "CAST(extract(ISODOW FROM o_orderdate) AS BIGINT)")
    .replace("{days}", "CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT)")
    .replace("{orders}", "orders"),
)
sql(
    "timestamp_functions",
    """
    SELECT event_id, CAST(extract(HOUR FROM ts) AS BIGINT) AS hour, CAST(extract(MINUTE FROM ts) AS BIGINT) AS minute,
           CAST(date_trunc('hour', ts) AS VARCHAR(30)) AS hour_start, CAST(ts AS DATE) AS day, ts + INTERVAL 90 MINUTE AS later, ts < TIMESTAMP '2024-01-15 00:00:00' AS early
    FROM {events}
    """,
)
sql(
    "math_functions",
    """
    SELECT c_custkey, abs(c_acctbal - 5000) AS abs, CAST(ceil(c_acctbal) AS BIGINT) AS ceil, CAST(floor(c_acctbal) AS BIGINT) AS floor, round(power(c_acctbal, 2), 2) AS power,
           round(sqrt(abs(c_acctbal)), 6) AS root, round(ln(abs(c_acctbal) + 1), 6) AS ln, round(log10(abs(c_acctbal) + 1), 6) AS log, round(exp(c_nationkey / 10.0), 6) AS exp,
           mod(c_custkey, 7) AS mod, CAST(sign(c_acctbal - 5000) AS BIGINT) AS sign, greatest(c_custkey, 100) AS greatest, least(c_custkey, 100) AS least,
           round(sin(c_nationkey), 6) AS sin, round(atan2(c_nationkey, 2), 6) AS angle, round(pi() * c_nationkey, 6) AS arc, c_custkey & 12 AS bits
    FROM {customer}
    """,
)
sql(
    "conditions_and_casts",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS band, CASE c_nationkey WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS named,
           coalesce(nullif(c_nationkey, 3), -1) AS nation, nullif(c_mktsegment, 'BUILDING') AS segment, CAST(c_custkey AS VARCHAR(20)) AS text,
           CAST(substring(c_name, 10) AS BIGINT) AS number, try_cast(c_mktsegment AS INT) AS no_number, CAST(floor(c_acctbal) AS INT) AS whole,
           CAST(c_acctbal AS DECIMAL(12, 2)) AS exact, CAST('2024-02-03' AS DATE) AS day, CAST(c_nationkey > 10 AS INT) AS flag, if(c_nationkey > 10, 'b', 'a') AS half
    FROM {customer}
    """,
)
sql(
    "json_functions",
    """
    SELECT event_id, get_json_object(props, '$.k') AS text, CAST(get_json_object(props, '$.k') AS INT) AS number, from_json(props, 'k INT').k AS field, get_json_object(props, '$.none') AS missing,
           CAST(json_array_length('[1, 2, 3]') AS BIGINT) AS n
    FROM {events}
    """,
    """
    SELECT event_id, json_extract_string(props, '$.k') AS text, CAST(json_extract_string(props, '$.k') AS INT) AS number, CAST(json_extract(props, '$.k') AS INT) AS field,
           json_extract_string(props, '$.none') AS missing, CAST(json_array_length('[1, 2, 3]') AS BIGINT) AS n
    FROM events
    """,
)
sql(
    "json_grouped",
    "SELECT get_json_object(props, '$.k') AS k, count(*) AS n, max(event_id) AS last FROM {events} GROUP BY get_json_object(props, '$.k') HAVING count(*) > 1",
    "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1 HAVING count(*) > 1",
)


@query(
    """
    SELECT p_partkey, CAST(CASE WHEN p_size < 1 THEN 0 WHEN p_size >= 50 THEN 6 ELSE floor((p_size - 1) * 5.0 / 49) + 1 END AS BIGINT) AS bucket,
           '{' || CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey AS VARCHAR) || '}' AS items, rpad(p_brand, 12, ' ') AS padded, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS titled
    FROM part
    """
)
def registered_functions(spark: SparkSession, d: str) -> DataFrame:
    """Functions that a session registers for its SQL: expressions, which Catalyst inlines, and a vectorized Python function."""
    register(spark)
    text = """
        SELECT p_partkey, bucket_of(p_size, 1, 50, 5) AS bucket, rendered(array(CAST(p_size AS BIGINT), p_partkey)) AS items, char_of(p_brand, 12) AS padded, titled(p_type) AS titled
        FROM {part}
    """
    return spark.sql(text, part=scan(spark, d, "part"))


@query("SELECT p_partkey, unnest(range(1, CAST(p_size % 3 AS BIGINT) + 1)) AS nth FROM part WHERE p_size % 3 > 0")
def registered_table_function(spark: SparkSession, d: str) -> DataFrame:
    """A table function in a lateral join."""
    register(spark)
    return spark.sql("SELECT p_partkey, nth FROM {part}, LATERAL counted(p_size % 3)", part=scan(spark, d, "part", ["p_partkey", "p_size"]))
