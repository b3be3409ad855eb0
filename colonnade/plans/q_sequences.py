"""Registered queries: time windows, per-entity sequences and the three
composite sequence jobs (block-delayed EWMA, recursive smoothing, coupon
chaining) plus the best-correlated-partner search."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.functions.scalars import ewma_fold
from colonnade.operators import aggregates as agg
from colonnade.operators import sequences as seq
from colonnade.operators import windows as win
from colonnade.plans import jobs
from colonnade.plans.common import r6, table, ts_text
from colonnade.plans.registry import register

# Fixed value: the smoothing factor of the trade-bar feature job.
ALPHA = 0.2
# Fixed value: bars per block of the delayed EWMA (the value for bar b uses bars
# up to 10 * floor((b - 1) / 10)).
BLOCK = 10

_WEEKLY_SQL = """
SELECT user_id, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS week, COUNT(event_id) AS n
FROM events GROUP BY 1, 2
"""


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    weekly = win.tumbling_count(table(spark, sf, "events"), "ts", ["user_id"], "event_id", out="n")
    return weekly.select("user_id", F.col("window.start").alias("week"), "n")


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    """Trade-bar view of events: entity user_id, bar = position by (ts, event_id)."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return seq.dense_ordinal(e, ["user_id"], ["ts", "event_id"], "bar")


_BARS_SQL = """
SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS bar FROM events
"""


@register("weekly_count", f"""
SELECT user_id, strftime(week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, n AS event_count FROM ({_WEEKLY_SQL}) w
""")
def weekly_count(spark: SparkSession, sf: str) -> DataFrame:
    w = _weekly(spark, sf)
    return w.select("user_id", ts_text("week").alias("week_start"), F.col("n").alias("event_count"))


@register("weekly_lag_features", f"""
SELECT user_id, strftime(week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, n AS event_count,
       CAST(lag(n, 1) OVER w AS DOUBLE) AS lag_1, CAST(lag(n, 2) OVER w AS DOUBLE) AS lag_2,
       CAST(lag(n, 3) OVER w AS DOUBLE) AS lag_3
FROM ({_WEEKLY_SQL}) t WINDOW w AS (PARTITION BY user_id ORDER BY week)
""")
def weekly_lag_features(spark: SparkSession, sf: str) -> DataFrame:
    w = _weekly(spark, sf)
    lagged = win.lag_features(w, ["user_id"], ["week"], "n", {"lag_1": 1, "lag_2": 2, "lag_3": 3})
    return lagged.select("user_id", ts_text("week").alias("week_start"), F.col("n").alias("event_count"),
                         *[F.col(c).cast("double").alias(c) for c in ("lag_1", "lag_2", "lag_3")])


NATION_WEEKS_SQL = """
SELECT c_nationkey AS nation, time_bucket(INTERVAL '7 days', o_orderdate, TIMESTAMP '1970-01-01') AS week, COUNT(o_orderkey) AS n
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""


def nation_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per nation and week: an entity that stays small however many customers there are."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate").join(c, "o_custkey")
    weekly = win.tumbling_count(o, "o_orderdate", ["nation"], "o_orderkey", out="n")
    return weekly.select("nation", F.col("window.start").alias("week"), "n")


YEAR_LAGS = {"lag_1": 1, "lag_2": 2, "lag_52": 52}


@register("weekly_lag_year", f"""
WITH w AS ({NATION_WEEKS_SQL}),
s AS (SELECT nation, MIN(week) AS lo, MAX(week) AS hi FROM w GROUP BY 1),
g AS (SELECT nation, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS week FROM s),
d AS (SELECT g.nation, g.week, COALESCE(w.n, 0) AS n FROM g LEFT JOIN w ON g.nation = w.nation AND g.week = w.week)
SELECT d.nation, strftime(d.week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, d.n,
       CAST(a.n AS DOUBLE) AS lag_1, CAST(b.n AS DOUBLE) AS lag_2, CAST(y.n AS DOUBLE) AS lag_52
FROM d LEFT JOIN d a ON a.nation = d.nation AND a.week = d.week - INTERVAL 7 DAY
LEFT JOIN d b ON b.nation = d.nation AND b.week = d.week - INTERVAL 14 DAY
LEFT JOIN d y ON y.nation = d.nation AND y.week = d.week - INTERVAL 364 DAY
""")
def weekly_lag_year(spark: SparkSession, sf: str) -> DataFrame:
    """W2 with the one-year lag of the forecast job, by the calendar."""
    lagged = win.calendar_lags(nation_weeks(spark, sf), ["nation"], "week", "n", YEAR_LAGS)
    return lagged.select("nation", ts_text("week").alias("week_start"), "n", *[F.col(c).cast("double").alias(c) for c in YEAR_LAGS])


@register("latest_per_group", """
SELECT user_id, event_id, value FROM (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1
""")
def latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return win.latest_per_group(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@register("all_but_latest", """
SELECT user_id, event_id, value FROM (
  SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn <> 1
""")
def all_but_latest(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return win.all_but_latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@register("split_last_per_entity", f"""
SELECT user_id, strftime(week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, n AS event_count,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY week DESC) = 1 THEN 'test' ELSE 'train' END AS split
FROM ({_WEEKLY_SQL}) t
""")
def split_last_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    w = _weekly(spark, sf)
    train, test = win.split_last_per_entity(w, ["user_id"], ["week"])
    out = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return out.select("user_id", ts_text("week").alias("week_start"), F.col("n").alias("event_count"), "split")


@register("ewma_block_delayed", f"""
WITH b AS ({_BARS_SQL}),
c AS (SELECT user_id, event_id, bar, value, CAST(floor((bar - 1) / {BLOCK}) * {BLOCK} AS BIGINT) AS cutoff FROM b)
SELECT c.user_id, c.event_id, c.bar, c.value,
       ROUND(SUM({ALPHA} * power({1 - ALPHA}, c.cutoff - p.bar) * p.value), 6) AS ewma,
       CASE WHEN c.cutoff > 0 THEN ROUND(1 - power({1 - ALPHA}, c.cutoff), 6) END AS weight_mass
FROM c LEFT JOIN b p ON p.user_id = c.user_id AND p.bar <= c.cutoff
GROUP BY c.user_id, c.event_id, c.bar, c.value, c.cutoff
""")
def ewma_block_delayed(spark: SparkSession, sf: str) -> DataFrame:
    """W6 / W9 (C11 feature): block-delayed EWMA for every bar of every entity."""
    out = seq.block_delayed_ewma(_bars(spark, sf), ["user_id"], "bar", "value", ALPHA, BLOCK)
    return out.select("user_id", "event_id", "bar", "value", r6("ewma").alias("ewma"),
                      r6("weight_mass").alias("weight_mass"))


@register("ses_recursive", f"""
WITH b AS ({_BARS_SQL})
SELECT c.user_id, c.event_id, c.bar, ROUND(SUM({ALPHA} * power({1 - ALPHA}, c.bar - p.bar) * p.value), 6) AS level
FROM b c JOIN b p ON p.user_id = c.user_id AND p.bar <= c.bar
GROUP BY c.user_id, c.event_id, c.bar
""")
def ses_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """L_t = alpha * y_t + (1 - alpha) * L_(t-1), L_0 = 0, for every bar."""
    out = seq.recursive_smoothing(_bars(spark, sf), ["user_id"], "bar", "value", ALPHA)
    return out.select("user_id", "event_id", "bar", r6("level").alias("level"))


@register("coupon_chain", """
WITH r AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_discount, o.o_totalprice AS cost
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
s AS (SELECT l_orderkey, l_linenumber, SUM(l_discount) AS p FROM r GROUP BY 1, 2),
f AS (SELECT l_orderkey, l_linenumber,
             COALESCE(product(1 - p) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS f
      FROM s)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_discount, r.cost,
       ROUND(r.cost * (1 - f.f) + 1e-7, 4) AS previous_deductions,
       ROUND(r.l_discount * r.cost * f.f + 1e-7, 4) AS coupon_discount
FROM r JOIN f ON r.l_orderkey = f.l_orderkey AND r.l_linenumber = f.l_linenumber
""")
def coupon_chain(spark: SparkSession, sf: str) -> DataFrame:
    """transaction = order, level = line number, pct = discount,
    cost = order total; several line items may share a level."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("cost"))
    out = jobs.coupon_chain(li, "l_orderkey", "l_linenumber", "l_discount", "cost", costs=o)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "cost",
                      F.round(F.col("previous_deductions") + 1e-7, 4).alias("previous_deductions"),
                      F.round(F.col("coupon_discount") + 1e-7, 4).alias("coupon_discount"))


# Fixed values of the test mapping: the five years of the correlation job.
CORR_YEARS = (1997, 1998, 1999, 2000, 2001)


@register("best_correlated_partner", """
WITH c AS (SELECT l_suppkey AS k, year(l_shipdate) AS y, COUNT(*) AS n FROM lineitem
           WHERE year(l_shipdate) BETWEEN 1997 AND 2001 GROUP BY 1, 2),
full_series AS (SELECT k FROM c GROUP BY k HAVING COUNT(*) = 5 AND STDDEV_POP(n) > 0),
s AS (SELECT c.* FROM c JOIN full_series USING (k)),
pairs AS (SELECT a.k AS a, b.k AS b, CORR(a.n, b.n) AS r FROM s a JOIN s b ON a.y = b.y AND a.k < b.k GROUP BY 1, 2),
ranked AS (SELECT a, b, r, row_number() OVER (PARTITION BY a ORDER BY ROUND(r, 9) DESC, b ASC) AS rn FROM pairs)
SELECT a AS l_suppkey, b AS partner, ROUND(r, 6) AS corr FROM ranked WHERE rn = 1
""")
def best_correlated_partner(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with line items in all five years; for each, the
    larger-keyed supplier whose yearly counts correlate best."""
    li = table(spark, sf, "lineitem")
    out = jobs.correlated_partners(li, "l_suppkey", "l_shipdate", CORR_YEARS)
    return out.select("l_suppkey", "partner", r6("corr").alias("corr"))


_CHUNK = 32


@register("array_fold", f"""
WITH o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, CAST((rn - 1) // {_CHUNK} AS BIGINT) AS chunk,
       ROUND(SUM({ALPHA} * power({1 - ALPHA}, (rn - 1) % {_CHUNK}) * value), 6) AS fold
FROM o GROUP BY 1, 2
""")
def array_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted fold of each ordered value array, first element weight alpha."""
    series = agg.collect_series(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", _CHUNK)
    return series.select("user_id", "chunk", r6(ewma_fold("values", ALPHA)).alias("fold"))


@F.pandas_udf(T.DoubleType())
def _ewma_list_udf(values: pd.Series) -> pd.Series:
    """G1 twin of :func:`ewma_fold` as an Arrow-batched pandas UDF (tests only)."""
    import numpy as np

    def fold(arr) -> float:
        a = np.asarray(arr, dtype="float64")
        return float(np.sum(ALPHA * (1.0 - ALPHA) ** np.arange(len(a)) * a))

    return values.map(fold)


@register("udf_vs_native", f"""
WITH o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT user_id, CAST((rn - 1) // {_CHUNK} AS BIGINT) AS chunk,
       ROUND(SUM({ALPHA} * power({1 - ALPHA}, (rn - 1) % {_CHUNK}) * value), 6) AS native,
       ROUND(SUM({ALPHA} * power({1 - ALPHA}, (rn - 1) % {_CHUNK}) * value), 6) AS udf
FROM o GROUP BY 1, 2
""")
def udf_vs_native(spark: SparkSession, sf: str) -> DataFrame:
    """G1: the native fold next to its pandas-UDF twin; both must agree."""
    series = agg.collect_series(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", _CHUNK)
    return series.select("user_id", "chunk", r6(ewma_fold("values", ALPHA)).alias("native"),
                         r6(_ewma_list_udf("values")).alias("udf"))


@register("weekly_count_dense", f"""
WITH w AS ({_WEEKLY_SQL}),
s AS (SELECT user_id, MIN(week) AS lo, MAX(week) AS hi FROM w GROUP BY 1),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS week FROM s)
SELECT g.user_id, strftime(g.week, '%Y-%m-%d %H:%M:%S.%f') AS week_start, COALESCE(w.n, 0) AS event_count,
       CAST(lag(COALESCE(w.n, 0), 1) OVER (PARTITION BY g.user_id ORDER BY g.week) AS DOUBLE) AS lag_1
FROM g LEFT JOIN w ON g.user_id = w.user_id AND g.week = w.week
""")
def weekly_count_dense(spark: SparkSession, sf: str) -> DataFrame:
    """D12 option: weekly counts with empty weeks filled with 0, then a calendar lag."""
    w = _weekly(spark, sf)
    dense = win.densify_periods(w, ["user_id"], "week", "n", "7 days", 0)
    lagged = win.lag_features(dense, ["user_id"], ["week"], "n", {"lag_1": 1})
    return lagged.select("user_id", ts_text("week").alias("week_start"), F.col("n").alias("event_count"),
                         F.col("lag_1").cast("double").alias("lag_1"))
