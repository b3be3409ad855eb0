"""Property tests with a handful of generated examples each."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colonnade.operators import ordering, sequences as seq
from colonnade.operators.similarity import keyed_correlation

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

series = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=45)


def _ewma(spark, rows, parts=1):
    df = spark.createDataFrame(rows, "t long, b long, y double").repartition(parts)
    out = seq.block_delayed_ewma(df, ["t"], "b", "y", 0.2, 10)
    return {(r.t, r.b): r.ewma for r in out.collect()}


@SETTINGS
@given(xs=series, a=st.integers(-3, 3), c=st.integers(-3, 3))
def test_ewma_is_linear_and_partition_independent(spark, xs, a, c):
    ys = [(i * 7) % 13 - 6 for i in range(len(xs))]
    rx = [(1, i + 1, float(v)) for i, v in enumerate(xs)]
    ry = [(1, i + 1, float(v)) for i, v in enumerate(ys)]
    rz = [(1, i + 1, float(a * x + c * y)) for i, (x, y) in enumerate(zip(xs, ys))]
    ex, ey, ez = _ewma(spark, rx), _ewma(spark, ry), _ewma(spark, rz, parts=3)
    for k, v in ez.items():
        if v is None:
            assert ex[k] is None and ey[k] is None
        else:
            assert v == pytest.approx(a * ex[k] + c * ey[k], abs=1e-9)


@SETTINGS
@given(levels=st.lists(st.tuples(st.integers(1, 4), st.integers(0, 25)), min_size=1, max_size=10))
def test_coupon_deductions_never_exceed_cost(spark, levels):
    # Keep every level sum <= 1 by scaling.
    total = {}
    for lvl, pct in levels:
        total[lvl] = total.get(lvl, 0) + pct
    scale = max([1] + [v / 100.0 for v in total.values()])
    rows = [(1, f"c{i}", lvl, pct / 100.0 / scale, 80.0) for i, (lvl, pct) in enumerate(levels)]
    df = spark.createDataFrame(rows, "idx long, coupon string, level int, pct double, cost double")
    out = seq.level_chained_discount(df, ["idx"], "level", "pct", "cost").collect()
    by_level = {}
    for r in out:
        by_level.setdefault(r.level, []).append(r)
    spent = 0.0
    for lvl in sorted(by_level):
        prev = {round(r.previous_deductions, 9) for r in by_level[lvl]}
        assert len(prev) == 1 and abs(prev.pop() - spent) < 1e-9  # same level, same base
        spent += sum(r.coupon_discount for r in by_level[lvl])
        assert -1e-9 <= spent <= 80.0 + 1e-9


@SETTINGS
@given(pairs=st.lists(st.tuples(st.floats(-100, 100), st.floats(-100, 100)), min_size=3, max_size=30))
def test_correlation_is_symmetric(spark, pairs):
    df = spark.createDataFrame([("k", x, y) for x, y in pairs], "k string, x double, y double")
    a = keyed_correlation(df, ["k"], "x", "y").first()["corr"]
    b = keyed_correlation(df, ["k"], "y", "x").first()["corr"]
    assert (a is None and b is None) or a == pytest.approx(b, nan_ok=True)


@SETTINGS
@given(words=st.lists(st.text(alphabet="abcdefghijklmnopqrstuvwxyzAZ019", min_size=1, max_size=6),
                      min_size=1, max_size=40, unique=True))
def test_range_buckets_preserve_order(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "artist string")
    rows = ordering.range_bucket_partition(df, "artist").withColumn("part", F.spark_partition_id()).collect()
    assert all(r.part == r.bucket for r in rows)
    # every key of a lower bucket sorts before every key of a higher bucket
    for r in rows:
        for q in rows:
            if r.bucket < q.bucket:
                assert r.artist < q.artist


@SETTINGS
@given(frac=st.floats(0.05, 0.9), seed=st.integers(0, 1000))
def test_samples_are_subsets(spark, frac, seed):
    df = spark.range(500).withColumnRenamed("id", "key")
    s = ordering.bernoulli_sample(df, frac, seed=seed)
    assert s.join(df, "key", "left_anti").count() == 0
    assert s.count() == s.distinct().count()
