"""Registered queries: aggregations (A1-A26) and the aggregate jobs C1, C2, C4."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions.scalars import period_label, prefix
from colonnade.operators import aggregates as agg
from colonnade.operators.ordering import distinct_rows
from colonnade.plans import jobs
from colonnade.plans.common import r6, table, ts_text
from colonnade.plans.registry import register


@register("monthly_avg_count", """
SELECT CAST(month AS BIGINT) AS month, ROUND(AVG(n), 6) AS avg_count
FROM (SELECT month(o_orderdate) AS month, year(o_orderdate) AS year, COUNT(*) AS n
      FROM orders GROUP BY 1, 2) t
GROUP BY month
""")
def monthly_avg_count(spark, sf):
    out = jobs.monthly_average_count(table(spark, sf, "orders"), "o_orderdate")
    return out.select("month", r6("avg_count").alias("avg_count"))


@register("group_count", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2
""")
def group_count(spark, sf):
    return agg.group_count(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "n")


@register("count_by_composite", """
SELECT o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) AS n
FROM orders GROUP BY 1, 2
""")
def count_by_composite(spark, sf):
    o = table(spark, sf, "orders")
    return agg.group_count(o, ["o_orderstatus", F.year("o_orderdate").cast("bigint").alias("year")], "n")


@register("sum_by_key", """
SELECT l_suppkey, ROUND(SUM(l_quantity), 6) AS sum_qty FROM lineitem GROUP BY 1
""")
def sum_by_key(spark, sf):
    out = agg.keyed_sum(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "sum_qty")
    return out.select("l_suppkey", r6("sum_qty").alias("sum_qty"))


# Fixed values of the test mapping: the "recent" years of the order calendar.
RECENT_YEARS = (1999, 2000, 2001)


@register("conditional_count", """
SELECT o_custkey, CAST(SUM(CASE WHEN year(o_orderdate) IN (1999, 2000, 2001) THEN 1 ELSE 0 END) AS BIGINT) AS n
FROM orders GROUP BY 1
""")
def conditional_count(spark, sf):
    o = table(spark, sf, "orders")
    return agg.conditional_count(o, ["o_custkey"], F.year("o_orderdate").isin(*RECENT_YEARS), "n")


@register("top10_conditional", """
SELECT o_custkey, n FROM (
  SELECT o_custkey, CAST(SUM(CASE WHEN year(o_orderdate) IN (1999, 2000, 2001) THEN 1 ELSE 0 END) AS BIGINT) AS n
  FROM orders GROUP BY 1) t
ORDER BY n DESC, o_custkey ASC LIMIT 10
""")
def top10_conditional(spark, sf):
    o = table(spark, sf, "orders")
    return jobs.top_places_recent(o, "o_custkey", F.year("o_orderdate"), RECENT_YEARS, 10)


@register("collect_series", """
WITH o AS (SELECT user_id, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, CAST((rn - 1) // 32 AS BIGINT) AS chunk,
       string_agg(CAST(value AS VARCHAR), ',' ORDER BY rn) AS values_text
FROM o GROUP BY 1, 2
""")
def collect_series(spark, sf):
    e = table(spark, sf, "events")
    out = agg.collect_series(e, ["user_id"], ["ts", "event_id"], "value", chunk_rows=32)
    return out.select("user_id", "chunk",
                      F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("values_text"))


@register("argmax_per_key", """
SELECT l_suppkey, l_partkey, l_extendedprice FROM (
  SELECT l_suppkey, l_partkey, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_partkey ASC) AS rn
  FROM lineitem) t WHERE rn = 1
""")
def argmax_per_key(spark, sf):
    return agg.argmax_per_key(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", "l_partkey")


@register("max_per_key", """
SELECT l_orderkey, MAX(l_linenumber) AS max_line FROM lineitem GROUP BY 1
""")
def max_per_key(spark, sf):
    return agg.max_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "max_line")


@register("global_max", """
SELECT MAX(max_line) AS max_max_line FROM (SELECT l_orderkey, MAX(l_linenumber) AS max_line FROM lineitem GROUP BY 1) t
""")
def global_max(spark, sf):
    per_key = agg.max_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", "max_line")
    return per_key.agg(F.max("max_line").alias("max_max_line"))


@register("global_min_max", """
SELECT strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS min_ts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_ts,
       MIN(value) AS min_value, MAX(value) AS max_value FROM events
""")
def global_min_max(spark, sf):
    out = agg.global_extremes(table(spark, sf, "events"), {"ts": ["min", "max"], "value": ["min", "max"]})
    return out.select(ts_text("min_ts").alias("min_ts"), ts_text("max_ts").alias("max_ts"), "min_value", "max_value")


@register("row_counts", """
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
                        AND event_type IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL) AS n_complete
FROM events
""")
def row_counts(spark, sf):
    return agg.row_counts(table(spark, sf, "events"))


@register("distinct_per_column", """
SELECT COUNT(DISTINCT o_orderkey) AS o_orderkey, COUNT(DISTINCT o_custkey) AS o_custkey,
       COUNT(DISTINCT o_orderstatus) AS o_orderstatus, COUNT(DISTINCT o_totalprice) AS o_totalprice,
       COUNT(DISTINCT o_orderdate) AS o_orderdate, COUNT(DISTINCT o_orderpriority) AS o_orderpriority
FROM orders
""")
def distinct_per_column(spark, sf):
    return agg.distinct_per_column(table(spark, sf, "orders"))


@register("first_last_row", """
SELECT strftime(arg_min(ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, arg_min(user_id, event_id) AS first_user_id,
       arg_min(event_type, event_id) AS first_event_type, arg_min(value, event_id) AS first_value,
       strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS last_ts, arg_max(user_id, event_id) AS last_user_id,
       arg_max(event_type, event_id) AS last_event_type, arg_max(value, event_id) AS last_value
FROM events
""")
def first_last_row(spark, sf):
    out = agg.first_last_row(table(spark, sf, "events"), "event_id", ["ts", "user_id", "event_type", "value"])
    return out.withColumns({"first_ts": ts_text("first_ts"), "last_ts": ts_text("last_ts")})


def _profile_sql(cols_types: list[tuple[str, str]], tbl: str, order: str) -> str:
    parts = []
    for c, t in cols_types:
        parts.append(
            f"SELECT (SELECT COUNT(*) FROM {tbl}) AS n_rows, '{c}' AS column_name, '{t}' AS data_type, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, COUNT(DISTINCT {c}) AS n_distinct, "
            f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, "
            f"CAST(arg_min({c}, {order}) AS VARCHAR) AS first_value, "
            f"CAST(arg_max({c}, {order}) AS VARCHAR) AS last_value FROM {tbl}")
    return "\nUNION ALL\n".join(parts)


_EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                ("event_type", "string"), ("value", "double"), ("props", "string")]


@register("profile_table", _profile_sql(_EVENT_TYPES, "events", "event_id"))
def profile_table(spark, sf):
    return agg.profile_table(table(spark, sf, "events"), "event_id")


@register("stddev_by_key", """
SELECT l_returnflag, ROUND(STDDEV_POP(l_quantity), 6) AS stddev FROM lineitem GROUP BY 1
""")
def stddev_by_key(spark, sf):
    out = agg.population_stddev(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity")
    return out.select("l_returnflag", r6("stddev").alias("stddev"))


@register("max_floor_zero", """
SELECT s_nationkey, GREATEST(MAX(s_acctbal), 0.0) AS max_value FROM supplier GROUP BY 1
""")
def max_floor_zero(spark, sf):
    return agg.max_floor_zero(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal")


@register("max_floor_zero_shifted", """
SELECT s_nationkey, ROUND(GREATEST(MAX(s_acctbal - 5000.0), 0.0), 6) AS max_value FROM supplier GROUP BY 1
""")
def max_floor_zero_shifted(spark, sf):
    s = table(spark, sf, "supplier").withColumn("shifted", F.col("s_acctbal") - F.lit(5000.0))
    out = agg.max_floor_zero(s, ["s_nationkey"], "shifted")
    return out.select("s_nationkey", r6("max_value").alias("max_value"))


@register("pairwise_corr", """
SELECT l_suppkey, ROUND(CORR(l_quantity, l_extendedprice), 6) AS corr FROM lineitem GROUP BY 1
""")
def pairwise_corr(spark, sf):
    from colonnade.operators.similarity import keyed_correlation
    out = keyed_correlation(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    return out.select("l_suppkey", r6("corr").alias("corr"))


# Fixed values of the test mapping: two order periods with three years each.
ORDER_PERIODS = (("early", 1995, 1997), ("late", 1998, 2000))
ORDER_DIVISORS = {"early": 3.0, "late": 3.0}

_PERIOD_SQL = """CASE WHEN year_text IS NULL OR length(year_text) <> 4 THEN 'Unknown'
          WHEN TRY_CAST(year_text AS INTEGER) IS NULL THEN 'Unknown'
          WHEN TRY_CAST(year_text AS INTEGER) BETWEEN 1995 AND 1997 THEN 'early'
          WHEN TRY_CAST(year_text AS INTEGER) BETWEEN 1998 AND 2000 THEN 'late'
          ELSE 'Other' END"""

_YEAR_TEXT_SQL = """CASE WHEN o_orderstatus = 'P' THEN substr(CAST(year(o_orderdate) AS VARCHAR), 1, 3)
                 ELSE CAST(year(o_orderdate) AS VARCHAR) END"""


def _year_text():
    y = F.year("o_orderdate").cast("string")
    return F.when(F.col("o_orderstatus") == "P", F.substring(y, 1, 3)).otherwise(y)


@register("period_label", f"""
SELECT {_PERIOD_SQL} AS period, COUNT(*) AS n
FROM (SELECT {_YEAR_TEXT_SQL} AS year_text FROM orders) t GROUP BY 1
""")
def period_label_query(spark, sf):
    o = table(spark, sf, "orders")
    return agg.group_count(o.select(period_label(_year_text(), ORDER_PERIODS).alias("period")), ["period"], "n")


@register("pivot_period_avg", f"""
SELECT region,
       ROUND(COUNT(*) FILTER (WHERE period = 'early') / 3.0, 6) AS early,
       ROUND(COUNT(*) FILTER (WHERE period = 'late') / 3.0, 6) AS late
FROM (SELECT substr(o_orderpriority, 1, 1) AS region, {_PERIOD_SQL} AS period
      FROM (SELECT o_orderpriority, {_YEAR_TEXT_SQL} AS year_text FROM orders) s) t
GROUP BY region
""")
def pivot_period_avg(spark, sf):
    o = table(spark, sf, "orders")
    out = jobs.region_period_average(o, prefix("o_orderpriority", 1), _year_text(), ORDER_PERIODS, ORDER_DIVISORS)
    return out.select("region", *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c) for c in ORDER_DIVISORS])


@register("two_sample_t", f"""
WITH p AS (
  SELECT region,
         COUNT(*) FILTER (WHERE period = 'early') / 3.0 AS early,
         COUNT(*) FILTER (WHERE period = 'late') / 3.0 AS late
  FROM (SELECT substr(o_orderpriority, 1, 1) AS region, {_PERIOD_SQL} AS period
        FROM (SELECT o_orderpriority, {_YEAR_TEXT_SQL} AS year_text FROM orders) s) t
  GROUP BY region)
SELECT ROUND((AVG(early) - AVG(late)) / SQRT((((COUNT(early) - 1) * VAR_SAMP(early) + (COUNT(late) - 1) * VAR_SAMP(late))
              / (COUNT(early) + COUNT(late) - 2)) * (1.0 / COUNT(early) + 1.0 / COUNT(late))), 6) AS t_stat,
       COUNT(early) AS n_a, COUNT(late) AS n_b
FROM p
""")
def two_sample_t(spark, sf):
    o = table(spark, sf, "orders")
    wide = jobs.region_period_average(o, prefix("o_orderpriority", 1), _year_text(), ORDER_PERIODS, ORDER_DIVISORS)
    wide = wide.fillna(0.0, subset=list(ORDER_DIVISORS))
    out = agg.two_sample_t(wide, "early", "late")
    return out.select(r6("t_stat").alias("t_stat"), "n_a", "n_b")


@register("word_count", """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) t GROUP BY 1
""")
def word_count(spark, sf):
    return agg.word_count(table(spark, sf, "documents"), "text", " ")


@register("ratio_of_sums", """
SELECT l_suppkey, ROUND(SUM(l_quantity) / SUM(l_extendedprice), 9) AS ratio FROM lineitem GROUP BY 1
""")
def ratio_of_sums(spark, sf):
    out = agg.ratio_of_sums(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    return out.select("l_suppkey", F.round("ratio", 9).alias("ratio"))


@register("distinct_years", """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS year_text FROM orders
WHERE length(CAST(year(o_orderdate) AS VARCHAR)) = 4
""")
def distinct_years(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("year_text"))
    return distinct_rows(o.filter(F.length("year_text") == 4))


@register("distinct_year_count", """
SELECT COUNT(DISTINCT CAST(year(o_orderdate) AS VARCHAR)) AS n_years FROM orders
WHERE length(CAST(year(o_orderdate) AS VARCHAR)) = 4
""")
def distinct_year_count(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("year_text"))
    return o.filter(F.length("year_text") == 4).agg(F.count_distinct("year_text").alias("n_years"))


@register("region_period_avg", f"""
SELECT region,
       ROUND(COUNT(*) FILTER (WHERE period = 'early') / 3.0, 6) AS early,
       ROUND(COUNT(*) FILTER (WHERE period = 'late') / 3.0, 6) AS late
FROM (SELECT substr(o_orderpriority, 1, 1) AS region, {_PERIOD_SQL} AS period
      FROM (SELECT o_orderpriority, {_YEAR_TEXT_SQL} AS year_text FROM orders) s) t
GROUP BY region ORDER BY region
""")
def region_period_avg(spark, sf):
    """C4: yearly average per region prefix and period (sorted by region); the
    period comparison itself is ``two_sample_t``."""
    o = table(spark, sf, "orders")
    out = jobs.region_period_average(o, prefix("o_orderpriority", 1), _year_text(), ORDER_PERIODS, ORDER_DIVISORS)
    return out.select("region", *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c) for c in ORDER_DIVISORS])


@register("pivot_period_avg_observed", f"""
WITH t AS (SELECT substr(o_orderpriority, 1, 1) AS region, {_PERIOD_SQL} AS period, year(o_orderdate) AS y
           FROM (SELECT o_orderpriority, o_orderdate, {_YEAR_TEXT_SQL} AS year_text FROM orders) s),
d AS (SELECT COUNT(DISTINCT y) FILTER (WHERE period = 'early') AS de,
             COUNT(DISTINCT y) FILTER (WHERE period = 'late') AS dl FROM t)
SELECT region,
       ROUND(COUNT(*) FILTER (WHERE period = 'early') / ANY_VALUE(d.de), 6) AS early,
       ROUND(COUNT(*) FILTER (WHERE period = 'late') / ANY_VALUE(d.dl), 6) AS late
FROM t, d GROUP BY region
""")
def pivot_period_avg_observed(spark, sf):
    """A22 with the D22 alternative: each period divided by the number of
    distinct years actually observed in it."""
    o = table(spark, sf, "orders")
    labelled = o.select(prefix("o_orderpriority", 1).alias("region"),
                        period_label(_year_text(), ORDER_PERIODS).alias("period"),
                        F.year("o_orderdate").alias("y"))
    divisors = agg.observed_divisors(labelled, "period", "y", list(ORDER_DIVISORS))
    out = agg.pivot_scaled(labelled, "region", "period", divisors)
    return out.select("region", *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c) for c in ORDER_DIVISORS])
