"""Registered queries: projections (P), predicates (F), scalar functions (X),
joins (J1, J2, J5), sorts and limits (O), unions (U)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions import predicates as pr
from colonnade.functions import scalars as sc
from colonnade.operators import aggregates as agg
from colonnade.operators import joins, ordering
from colonnade.operators import projections as proj
from colonnade.plans.common import r6, table, ts_text
from colonnade.plans.registry import register
from colonnade.sources.sinks import fetch_limited


@register("project_select", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def project_select(spark: SparkSession, sf: str) -> DataFrame:
    return proj.select_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@register("project_drop", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
""")
def project_drop(spark: SparkSession, sf: str) -> DataFrame:
    drop = ["l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "not_a_column"]
    return proj.drop_columns(table(spark, sf, "lineitem"), drop)


@register("project_derived", """
SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice * (1 - l_discount), 6) AS disc_price,
       ROUND(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge
FROM lineitem
""")
def project_derived(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    out = proj.with_columns(li, {"disc_price": r6(disc), "charge": r6(disc * (1 + F.col("l_tax")))})
    return out.select("l_orderkey", "l_linenumber", "disc_price", "charge")


@register("project_literal", """
SELECT n_nationkey, n_name, 'tpch' AS source, CAST(0 AS DOUBLE) AS previous_deductions FROM nation
""")
def project_literal(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return proj.with_literal(proj.with_literal(n, "source", "tpch"), "previous_deductions", 0.0)


@register("project_cast", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey_text,
       CAST(o_custkey AS DOUBLE) AS custkey_double, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_date,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_int
FROM orders
""")
def project_cast(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("custkey_text"), F.col("o_custkey").alias("custkey_double"),
        F.col("o_orderdate").alias("order_date"), F.substring("o_orderpriority", 1, 1).alias("priority_int"))
    out = proj.cast_columns(o, {"o_orderkey": "int", "custkey_text": "string", "custkey_double": "double",
                                "order_date": "date", "priority_int": "int"})
    return out.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@register("project_rename", "SELECT r_regionkey AS region_id, r_name AS region_name FROM region")
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return proj.rename_columns(table(spark, sf, "region"), {"r_regionkey": "region_id", "r_name": "region_name"})


@register("concat_key", """
SELECT p_brand || ',' || p_type AS key, COUNT(*) AS n FROM part GROUP BY 1
""")
def concat_key(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return agg.group_count(p.select(sc.concat_key("p_brand", "p_type").alias("key")), ["key"], "n")


@register("filter_ts_range", """
SELECT event_id, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts <= TIMESTAMP '2024-01-15 00:00:00'
""")
def filter_ts_range(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    lo, hi = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return e.filter(pr.in_range("ts", lo, hi)).select("event_id", "user_id", "event_type")


@register("filter_sql_text", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 10 AND l_returnflag = 'R'
""")
def filter_sql_text(spark: SparkSession, sf: str) -> DataFrame:
    li = pr.filter_sql(table(spark, sf, "lineitem"), "l_quantity <= 10 AND l_returnflag = 'R'")
    return li.select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_in_set", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders
WHERE year(o_orderdate) IN (1996, 1998, 2000)
""")
def filter_in_set(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    kept = o.filter(pr.in_years(o, "o_orderdate", [1996, 1998, 2000]))
    return kept.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))


@register("filter_having", """
WITH c AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1)
SELECT user_id, n FROM c WHERE n = (SELECT MAX(n) FROM c)
""")
def filter_having(spark: SparkSession, sf: str) -> DataFrame:
    """keep the groups whose aggregate equals a value computed from the data
    (the largest count); the scalar is a subquery, not a driver round trip."""
    counts = agg.group_count(table(spark, sf, "events"), ["user_id"], "n")
    top = counts.select(F.max("n")).scalar()
    return counts.filter(F.col("n") == top)


@register("drop_nulls", """
WITH w AS (SELECT user_id, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS week, COUNT(event_id) AS n
           FROM events GROUP BY 1, 2),
l AS (SELECT user_id, week, n, lag(n, 1) OVER (PARTITION BY user_id ORDER BY week) AS lag_1 FROM w)
SELECT user_id, strftime(week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, n, lag_1 FROM l WHERE lag_1 IS NOT NULL
""")
def drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    from colonnade.operators.windows import lag_features, tumbling_count
    weekly = tumbling_count(table(spark, sf, "events"), "ts", ["user_id"], "event_id", out="n")
    weekly = weekly.select("user_id", F.col("window.start").alias("week"), "n")
    lagged = lag_features(weekly, ["user_id"], ["week"], "n", {"lag_1": 1})
    return pr.drop_nulls(lagged).select("user_id", ts_text("week").alias("week_start"), "n", "lag_1")


_TOKENS_SQL = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS token FROM orders
UNION ALL SELECT CAST(o_custkey AS VARCHAR) FROM orders
UNION ALL SELECT '-' || CAST(o_custkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderpriority FROM orders
"""


def _order_tokens(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(F.explode(F.array(
        F.year("o_orderdate").cast("string"), F.col("o_custkey").cast("string"),
        F.concat(F.lit("-"), F.col("o_custkey").cast("string")), F.col("o_orderpriority"))).alias("token"))


@register("filter_valid_year", f"""
SELECT token, COUNT(*) AS n FROM ({_TOKENS_SQL}) t
WHERE regexp_matches(token, '^(?:[0-9]{{1,4}}|-[0-9]{{1,3}})$') GROUP BY 1
""")
def filter_valid_year(spark: SparkSession, sf: str) -> DataFrame:
    toks = _order_tokens(spark, sf)
    return agg.group_count(toks.filter(pr.is_valid_year("token")), ["token"], "n")


@register("filter_year_range", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
WHERE year(o_orderdate) BETWEEN 1997 AND 1999
""")
def filter_year_range(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.filter(pr.in_year_range(o, "o_orderdate", 1997, 1999)).select("o_orderkey", F.year("o_orderdate").alias("year"))


@register("filter_key_set", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber IN (1, 3, 5)
""")
def filter_key_set(spark: SparkSession, sf: str) -> DataFrame:
    """F3 on plain columns."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.filter(pr.in_set("l_returnflag", ["A", "R"]) & pr.in_set("l_linenumber", [1, 3, 5]))


@register("filter_contains_ci", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ol')
""")
def filter_contains_ci(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return p.filter(pr.contains_ci("p_name", "OL"))


@register("filter_complete_series", """
SELECT l_suppkey, COUNT(DISTINCT year(l_shipdate)) AS n_years FROM lineitem
WHERE year(l_shipdate) BETWEEN 1997 AND 2001 GROUP BY 1 HAVING COUNT(DISTINCT year(l_shipdate)) = 5
""")
def filter_complete_series(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    in_time = li.filter(pr.in_year_range(li, "l_shipdate", 1997, 2001))
    per_year = in_time.select("l_suppkey", F.year("l_shipdate").alias("year")).distinct()
    counts = agg.group_count(per_year, ["l_suppkey"], "n_years")
    return counts.filter(F.col("n_years") == 5)


@register("filter_nonzero", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <> 0
""")
def filter_nonzero(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return li.filter(pr.non_zero("l_discount"))


@register("split_part_month", """
SELECT split_part(strftime(o_orderdate, '%m/%d/%Y'), '/', 1) AS month_text, COUNT(*) AS n FROM orders GROUP BY 1
""")
def split_part_month(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "MM/dd/yyyy").alias("d"))
    return agg.group_count(o.select(sc.nth_field("d", "/", 0).alias("month_text")), ["month_text"], "n")


@register("prefix_region", """
SELECT substr(o_orderpriority, 1, 1) AS region, COUNT(*) AS n FROM orders GROUP BY 1
""")
def prefix_region(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return agg.group_count(o.select(sc.prefix("o_orderpriority", 1).alias("region")), ["region"], "n")


@register("token_count", """
SELECT len(string_split_regex(rtrim(text), '\\s+')) AS n_tokens, COUNT(*) AS n_docs FROM documents GROUP BY 1
""")
def token_count(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(sc.token_count("text").cast("bigint").alias("n_tokens"))
    return agg.group_count(d, ["n_tokens"], "n_docs")


@register("calendar_parts", """
SELECT CAST(hour(ts) AS BIGINT) AS hour_of_day, CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week,
       CAST(month(ts) AS BIGINT) AS month, COUNT(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        sc.hour_of_day("ts").cast("bigint").alias("hour_of_day"),
        sc.day_of_week("ts").cast("bigint").alias("day_of_week"), sc.month_of("ts").cast("bigint").alias("month"))
    return agg.group_count(e, ["hour_of_day", "day_of_week", "month"], "n")


@register("to_date_count", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS n FROM events GROUP BY 1
""")
def to_date_count(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.date_format(sc.to_date("ts"), "yyyy-MM-dd").alias("day"))
    return agg.group_count(e, ["day"], "n")


@register("string_buckets", """
SELECT c_name, CASE WHEN c_mktsegment < 'f' THEN 0 WHEN c_mktsegment < 'k' THEN 1 WHEN c_mktsegment < 'p' THEN 2
                    WHEN c_mktsegment < 'u' THEN 3 ELSE 4 END AS bucket,
       CASE WHEN lower(c_mktsegment) < 'f' THEN 0 WHEN lower(c_mktsegment) < 'k' THEN 1
            WHEN lower(c_mktsegment) < 'p' THEN 2 WHEN lower(c_mktsegment) < 'u' THEN 3 ELSE 4 END AS bucket_ci
FROM customer
""")
def string_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Code-unit order puts every capitalised value in bucket 0 (D9);
    ``bucket_ci`` is the case-insensitive option."""
    c = table(spark, sf, "customer")
    return c.select("c_name", sc.string_order_bucket("c_mktsegment").alias("bucket"),
                    sc.string_order_bucket("c_mktsegment", case_insensitive=True).alias("bucket_ci"))


@register("percent_format", """
SELECT o_orderpriority, printf('%.6f%%', 100 * AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)) AS share_f
FROM orders GROUP BY 1
""")
def percent_format(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    share = o.groupBy("o_orderpriority").agg(F.avg(sc.flag(F.col("o_orderstatus") == "F").cast("double")).alias("s"))
    return share.select("o_orderpriority", sc.percent_text("s").alias("share_f"))


@register("safe_ratio", """
SELECT l_orderkey, l_linenumber, ROUND(l_tax / NULLIF(l_discount, 0), 6) AS tax_per_discount,
       ROUND(SQRT(l_quantity), 6) AS sqrt_qty, ROUND(POWER(l_discount, 2), 6) AS discount_sq,
       ROUND(ABS(l_tax - l_discount), 6) AS abs_gap
FROM lineitem
""")
def safe_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Arithmetic, abs, division that yields null at 0, pow, sqrt."""
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     r6(sc.safe_ratio("l_tax", "l_discount")).alias("tax_per_discount"),
                     r6(F.sqrt("l_quantity")).alias("sqrt_qty"), r6(F.pow("l_discount", 2)).alias("discount_sq"),
                     r6(F.abs(F.col("l_tax") - F.col("l_discount"))).alias("abs_gap"))


@register("join_inner_multi_key", """
WITH a AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n_dup, SUM(l_quantity) AS qty_total
           FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, a.n_dup, ROUND(a.qty_total, 6) AS qty_total
FROM lineitem l JOIN a ON l.l_orderkey = a.l_orderkey AND l.l_linenumber = a.l_linenumber
""")
def join_inner_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n_dup"), r6(F.sum("l_quantity")).alias("qty_total"))
    j = joins.join_on(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), per_line,
                      ["l_orderkey", "l_linenumber"])
    return j


@register("join_left", """
SELECT c.c_custkey, c.c_name, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, o.o_totalprice FROM customer c
LEFT JOIN (SELECT o_custkey, o_orderkey, o_totalprice FROM orders
           WHERE year(o_orderdate) = 2001 AND o_orderstatus = 'F') o ON c.c_custkey = o.o_custkey
""")
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders")
    o = o.filter(pr.in_years(o, "o_orderdate", [2001]) & (F.col("o_orderstatus") == "F"))
    o = o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("string").alias("o_orderkey"),
                 "o_totalprice")
    return joins.join_on(c, o, ["c_custkey"], "left")


@register("group_mean_broadcast", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
       ROUND(AVG(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS group_mean
FROM lineitem
""")
def group_mean_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = joins.attach_group_aggregate(li, ["l_suppkey"], "l_quantity", "group_mean")
    return out.withColumn("group_mean", r6("group_mean"))


@register("sort_asc", "SELECT n_name, n_nationkey FROM nation ORDER BY n_name")
def sort_asc(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.sort_by(table(spark, sf, "nation").select("n_name", "n_nationkey"), ["n_name"])


@register("limit_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 20
""")
def limit_n(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return fetch_limited(ordering.sort_by(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]), 20)


@register("union_all", """
SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier
""")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                            F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"),
                                            F.col("s_suppkey").alias("key"))
    return ordering.union_all(c, s)


@register("union_by_shape", """
SELECT word1, word2, year FROM (VALUES (NULL, NULL, NULL)) v(word1, word2, year) WHERE false
UNION ALL SELECT split_part(p_name, ' ', 2), NULL, CAST(p_size + 1990 AS VARCHAR) FROM part
UNION ALL SELECT split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), CAST(p_size + 1990 AS VARCHAR) FROM part
""")
def union_by_shape(spark: SparkSession, sf: str) -> DataFrame:
    """1-gram and 2-gram shapes merged with missing columns as null."""
    p = table(spark, sf, "part")
    year = (F.col("p_size") + 1990).cast("string").alias("year")
    one = p.select(F.get(F.split("p_name", " "), 1).alias("word1"), year)
    two = p.select(F.get(F.split("p_name", " "), 0).alias("word1"), F.get(F.split("p_name", " "), 1).alias("word2"), year)
    return ordering.union_all(one, two, allow_missing=True).select("word1", "word2", "year")
