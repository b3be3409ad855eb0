"""Aggregations (A*) on literal rows, decisions D6, D7/D8, D21, D22."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.operators import aggregates as agg
from colonnade.operators.joins import attach_group_aggregate


def test_max_floor_zero_negative_and_nan(spark):
    rows = [("a", -3.0), ("a", -1.0), ("b", float("nan")), ("b", 2.5), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.max_value for r in agg.max_floor_zero(df, ["k"], "v").collect()}
    assert got == {"a": 0.0, "b": 2.5, "c": 0.0}


def test_population_stddev_matches_numpy(spark):
    vals = [3.0, 7.0, 7.0, 19.0, 24.0, 1e6 + 1, 1e6 + 2]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(3)
    got = agg.population_stddev(df, [], "v").first()[0]
    assert got == pytest.approx(float(np.std(vals)), rel=1e-12)


def test_conditional_count_keeps_zero_groups(spark):
    rows = [("blk1", "2018"), ("blk1", "2010"), ("blk2", "2009"), ("blk3", "2020"), ("blk3", "2019")]
    df = spark.createDataFrame(rows, "block string, year string")
    got = {r.block: r.n for r in agg.conditional_count(df, ["block"], F.col("year").isin("2018", "2019", "2020")).collect()}
    assert got == {"blk1": 1, "blk2": 0, "blk3": 2}


def test_average_of_counts(spark):
    rows = [("01", "2001")] * 3 + [("01", "2002")] * 1 + [("02", "2001")] * 2
    df = spark.createDataFrame(rows, "m string, y string")
    got = {r.m: r.avg_count for r in agg.average_of_counts(df, ["m"], ["y"]).collect()}
    assert got == {"01": 2.0, "02": 2.0}


def test_argmax_tie_breaks_to_smaller_candidate(spark):
    rows = [(1, 5, 0.9), (1, 3, 0.9), (1, 7, 0.1), (2, 9, -1.0)]
    df = spark.createDataFrame(rows, "k int, c int, s double")
    got = {r.k: r.c for r in agg.argmax_per_key(df, "k", "s", "c").collect()}
    assert got == {1: 3, 2: 9}


def test_collect_series_chunks_are_ordered_and_bounded(spark):
    rows = [("hot", i, float(i)) for i in range(1, 251)] + [("cold", i, -float(i)) for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(5)
    out = agg.collect_series(df, ["k"], ["t"], "v", chunk_rows=100).collect()
    hot = sorted((r.chunk, r["values"]) for r in out if r.k == "hot")
    assert [c for c, _ in hot] == [0, 1, 2]
    assert [len(v) for _, v in hot] == [100, 100, 50]
    assert sum((v for _, v in hot), []) == [float(i) for i in range(1, 251)]
    cold = [r["values"] for r in out if r.k == "cold"]
    assert cold == [[-1.0, -2.0, -3.0]]


def test_profile_and_counts(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.5), (3, "a", 2.5)], "id int, s string, x double")
    prof = {r.column_name: r for r in agg.profile_table(df, "id").collect()}
    assert prof["s"].n_distinct == 2 and prof["x"].n_null == 1
    assert prof["x"].first_value is None and prof["x"].last_value == "2.5"
    assert prof["id"].data_type == "int" and prof["id"].n_rows == 3
    rc = agg.row_counts(df).first()
    assert (rc.n_rows, rc.n_complete) == (3, 2)
    fl = agg.first_last_row(df, "id", ["s"]).first()
    assert (fl.first_s, fl.last_s) == ("a", "a")


def test_pivot_scaled_and_t_stat(spark):
    rows = [("1", "Daly")] * 22 + [("1", "Emanuel")] * 9 + [("2", "Daly")] * 11 + [("2", "Emanuel")] * 27
    df = spark.createDataFrame(rows, "region string, period string")
    wide = agg.pivot_scaled(df, "region", "period", {"Daly": 11.0, "Emanuel": 9.0})
    got = {r.region: (r.Daly, r.Emanuel) for r in wide.collect()}
    assert got == {"1": (2.0, 1.0), "2": (1.0, 3.0)}
    t = agg.two_sample_t(wide, "Daly", "Emanuel").first()
    a, b = np.array([2.0, 1.0]), np.array([1.0, 3.0])
    sp = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    expected = (a.mean() - b.mean()) / math.sqrt(sp * (1 / len(a) + 1 / len(b)))
    assert t.t_stat == pytest.approx(expected)


def test_group_aggregate_join_equals_window(spark):
    from pyspark.sql import Window
    rows = [("a", 1.0), ("a", 3.0), ("b", 10.0), ("hot", 2.0)] + [("hot", 4.0)] * 50
    df = spark.createDataFrame(rows, "k string, v double")
    joined = sorted(tuple(r) for r in attach_group_aggregate(df, ["k"], "v").collect())
    window = sorted(tuple(r) for r in df.withColumn("m", F.avg("v").over(Window.partitionBy("k"))).collect())
    assert joined == window


def test_word_count_and_ratio(spark):
    df = spark.createDataFrame([("a b a",), ("b  c",)], "t string")
    got = {r.word: r["count"] for r in agg.word_count(df, "t").collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "": 1}
    r = spark.createDataFrame([("k", 3, 4), ("k", 1, 4), ("z", 1, 0)], "k string, o int, v int")
    got = {x.k: x.ratio for x in agg.ratio_of_sums(r, ["k"], "o", "v").collect()}
    assert got == {"k": 0.5, "z": None}


def test_degenerate_inputs_give_null_not_errors(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert agg.two_sample_t(one, "a", "b").first().t_stat is None
    df = spark.createDataFrame([("r", "p")], "region string, period string")
    assert agg.pivot_scaled(df, "region", "period", {"p": 0.0}).first()["p"] is None


def test_argmax_with_string_candidates(spark):
    from colonnade.operators import aggregates as agg
    df = spark.createDataFrame([("a", 2.0, "bb"), ("a", 2.0, "b"), ("a", 2.0, "ba"), ("a", 1.0, "a"), ("c", None, "x"), ("d", 1.0, "é"), ("d", 1.0, "z")],
                               "k string, s double, c string")
    assert {r.k: r.c for r in agg.argmax_per_key(df, "k", "s", "c").collect()} == {"a": "b", "c": "x", "d": "z"}
    assert {r.k: r.c for r in agg.argmax_per_key(df, "k", "s", "c", prefer_smaller=False).collect()} == {"a": "bb", "c": "x", "d": "é"}


def test_distinct_counts_of_every_type(spark):
    from colonnade.operators import aggregates as agg
    df = spark.createDataFrame([(0.0, b"\x00", [1], None, "a"), (-0.0, b"\xff", [1], None, "A"), (float("nan"), b"\xff", [2], None, None)],
                               "d double, b binary, a array<int>, n int, s string")
    got = agg.distinct_per_column(df)
    assert got.first().asDict() == {"d": 2, "b": 2, "a": 2, "n": 0, "s": 2}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert agg.distinct_per_column(df.limit(0)).first().asDict() == dict.fromkeys("dbans", 0)
