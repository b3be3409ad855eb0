"""Per-entity sequence operators against brute force (W6-W8, ordinals, prefix sums)."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from colonnade.operators import sequences as seq
from tests.test_functions import EWMA_CASES


def _skewed(spark, n_hot=3000, n_cold=40, seed=7):
    rnd = random.Random(seed)
    rows = [("hot", i, rnd.randint(0, 50), round(rnd.uniform(-100, 100), 2)) for i in range(n_hot)]
    for k in range(n_cold):
        rows += [(f"c{k}", 10_000 + k * 100 + i, rnd.randint(0, 50), round(rnd.uniform(-100, 100), 2))
                 for i in range(rnd.randint(1, 30))]
    rows.append((None, 99_999, 1, 1.0))
    rows.append((None, 99_998, 0, 2.0))
    return spark.createDataFrame(rows, "k string, id long, t long, v double").repartition(7)


def test_dense_ordinal_equals_row_number_on_skewed_keys(spark):
    df = _skewed(spark)
    ours = seq.dense_ordinal(df, ["k"], ["t", "id"], "o", split_rows=400)
    ref = df.withColumn("o2", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    joined = ours.join(ref.select("id", "o2"), "id")
    assert joined.count() == df.count()
    assert joined.filter(F.col("o") != F.col("o2")).count() == 0
    # the hot key really is split: no window partition holds all its rows
    tagged, hot, _ = seq._pieces(df, ["k"], ["t", "id"], 400)
    sizes = [r["count"] for r in tagged.groupBy("k", "_piece").count().collect()]
    assert max(sizes) <= 2 * 400 and tagged.filter("k = 'hot'").select("_piece").distinct().count() >= 7
    assert {r.k for r in hot.select("k").distinct().collect()} == {"hot"}
    # default threshold: nothing is hot, plain numbering gives the same result
    plain = seq.dense_ordinal(df, ["k"], ["t", "id"], "o")
    assert plain.join(ref.select("id", "o2"), "id").filter(F.col("o") != F.col("o2")).count() == 0


def test_dense_ordinal_splits_hot_group_with_constant_first_order_column(spark):
    rows = [("hot", 5, i) for i in range(900)] + [("cold", 1, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    tagged, _, _ = seq._pieces(df, ["k"], ["t", "id"], 100)
    assert tagged.filter("k = 'hot'").select("_piece").distinct().count() >= 8
    ours = seq.dense_ordinal(df, ["k"], ["t", "id"], "o", split_rows=100)
    assert sorted((r.k, r.id, r.o) for r in ours.collect()) == sorted(
        [("hot", i, i + 1) for i in range(900)] + [("cold", i, i + 1) for i in range(5)])


def test_dense_ordinal_null_first_order_values_stay_first(spark):
    rows = [("hot", 5, i) for i in range(300)] + [("hot", None, 1000 + i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    ours = {r.id: r.o for r in seq.dense_ordinal(df, ["k"], ["t", "id"], "o", split_rows=50).collect()}
    assert [ours[1000 + i] for i in range(3)] == [1, 2, 3]
    assert sorted(ours.values()) == list(range(1, 304))


def _brute_decayed(rows, d):
    out = {}
    by_key = {}
    for k, o, v in rows:
        by_key.setdefault(k, []).append((o, v))
    for k, seq_ in by_key.items():
        seq_.sort()
        acc = 0.0
        for o, v in seq_:
            acc = acc * d + v
            out[(k, o)] = acc
    return out


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "-id"], ["s", "id"], ["-s", "id"], ["-f", "id"], ["w", "-id"], ["-d", "-ts", "id"], ["-n", "id"]])
def test_pieces_stay_small_on_ties_strings_and_descending_columns(spark, order):
    """990 of 1000 rows share t; s is a string with common prefixes, f holds NaN and nulls, w crowds near zero."""
    rnd = random.Random(4)
    rows = [(i, 5 if i < 990 else i, "same prefix " + "x" * rnd.randint(0, 6) + str(rnd.randint(0, 9)) if i % 7 else None,
             float("nan") if i % 5 == 0 else None if i % 5 == 1 else rnd.uniform(-1, 1), 10.0 ** -rnd.randint(0, 300)) for i in range(1000)]
    df = (spark.createDataFrame(rows, "id long, t long, s string, f double, w double")
          .withColumns({"d": F.date_add(F.lit("1969-12-30"), F.col("t").cast("int") % 9), "n": F.col("t").cast("decimal(20,3)"),
                        "ts": F.expr("cast(timestampadd(HOUR, id % 50, timestamp'2021-03-28 00:00:00') as timestamp_ntz)")}))
    df = df.withColumn("k", F.lit("hot")).repartition(5)
    tagged, _, _ = seq._pieces(df, ["k"], order, 100)
    assert max(r["count"] for r in tagged.groupBy("_piece").count().collect()) <= 200
    ours = seq.dense_ordinal(df, ["k"], order, "o", split_rows=100).select("id", "o")
    window = [F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]
    ref = df.select("id", F.row_number().over(Window.partitionBy("k").orderBy(*window)).alias("o"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.collect()))
    whole = seq.dense_ordinal(df, [], order, "o", split_rows=100).select("id", "o")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, ref.collect()))


def test_ordinals_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(400).select(F.lit("a").alias("k"), "id", F.expr("cast(timestampadd(MINUTE, cast(id as int) * 7, timestamp_ntz'2021-10-31 00:00:00') as timestamp_ntz)").alias("ts"))
    try:
        for z in ("Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            up = {r.id: r.o for r in seq.dense_ordinal(df, ["k"], ["ts", "id"], "o", split_rows=50).collect()}
            down = {r.id: r.o for r in seq.dense_ordinal(df, ["k"], ["-ts"], "o", split_rows=50).collect()}
            assert up == {i: i + 1 for i in range(400)} and down == {i: 400 - i for i in range(400)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_building_a_plan_runs_no_job(spark):
    df = _skewed(spark, 300)
    spark.sparkContext.setJobGroup("plan-only", "no action expected")
    try:
        bars = seq.dense_ordinal(df, ["k"], ["t", "id"], "o", split_rows=50)
        seq.block_delayed_ewma(bars, ["k"], "o", "v")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("chunk,decay", [(None, 0.8), (3, 0.8), (4, 0.5), (5, 1.0), (2, 0.0), (7, 0.6), (2, 0.999), (3, 1e-30), (2, 1e-200)])
def test_decayed_prefix_sum_matches_recurrence(spark, chunk, decay):
    # chunk=None: one chunk; small chunks with decay near 1: a tree of several levels; small decays: copies.
    rnd = random.Random(3)
    rows = [(k, o, rnd.uniform(-10, 10)) for k, n in (("a", 23), ("b", 1), ("c", 9), ("hot", 61)) for o in range(1, n + 1)]
    df = spark.createDataFrame(rows, "k string, o long, v double")
    out = seq.decayed_prefix_sum(df, ["k"], "o", "v", decay, "e", chunk=chunk).collect()
    expected = _brute_decayed(rows, decay)
    assert len(out) == len(rows)
    for r in out:
        assert r.e == pytest.approx(expected[(r.k, r.o)], rel=1e-9, abs=1e-9)


def test_decayed_prefix_sum_keeps_huge_values_that_decay_over_chunks(spark):
    # 1e300 decays over 1,000 ordinals by 1e-97 with later values of zero: no chunk may drop it.
    df = spark.range(1, 1001).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.when(F.col("id") == 1, 1e300).otherwise(0.0).alias("v"))
    for chunk in (None, 2, 13):
        got = {r.o: r.e for r in seq.decayed_prefix_sum(df, ["k"], "o", "v", 0.8, "e", chunk=chunk).collect()}
        assert all(got[o] == pytest.approx(1e300 * 0.8 ** (o - 1), rel=1e-9) for o in (1, 2, 3, 500, 1000))
    small = {r.o: r.e for r in seq.decayed_prefix_sum(df, ["k"], "o", "v", 1e-100, "e").collect()}
    assert [small[o] for o in (1, 2, 3, 6, 7, 8)] == pytest.approx([1e300, 1e200, 1e100, 1e-200, 1e-300, 0.0], rel=1e-9)


def _bars_fixture(spark):
    # Trades with the reference vectors as bars 1..10 (bar 1 = last list item),
    # followed by 13 more bars; plus trades with 5, 10, 20 and 120 bars.
    rows = []
    for t, (vals, _) in enumerate(EWMA_CASES):
        bars = list(reversed(vals)) + [float(100 + t)] * 13
        rows += [(1000 + t, b + 1, float(v)) for b, v in enumerate(bars)]
    for tid, n in ((5, 5), (10, 10), (20, 20), (120, 120)):
        rows += [(tid, b, float((b * 7) % 11 - 5)) for b in range(1, n + 1)]
    return rows, spark.createDataFrame(rows, "trade_id long, bar_num long, profit double")


def _brute_ewma(rows, alpha=0.2, block=10):
    series = {}
    for t, b, v in rows:
        series.setdefault(t, {})[b] = v
    out = {}
    for t, s in series.items():
        for b in s:
            c = block * ((b - 1) // block)
            out[(t, b)] = None if c == 0 else sum(alpha * (1 - alpha) ** (c - j) * s[j] for j in range(1, c + 1))
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
def test_block_delayed_ewma(spark, how):
    rows, df = _bars_fixture(spark)
    out = seq.block_delayed_ewma(df, ["trade_id"], "bar_num", "profit", 0.2, 10, how=how).collect()
    expected = _brute_ewma(rows)
    if how == "left":
        assert len(out) == len(rows)
    else:
        assert len(out) == sum(1 for v in expected.values() if v is not None)
    for r in out:
        e = expected[(r.trade_id, r.bar_num)]
        if e is None:
            assert r.ewma is None and r.weight_mass is None
        else:
            assert r.ewma == pytest.approx(e, rel=1e-9, abs=1e-9)
            assert r.weight_mass == pytest.approx(1 - 0.8 ** (10 * ((r.bar_num - 1) // 10)))
    # the reference results: bars 11..20 of the four trades
    got = {(r.trade_id, r.bar_num): r.ewma for r in out}
    for t, (_, value) in enumerate(EWMA_CASES):
        for b in range(11, 21):
            assert got[(1000 + t, b)] == pytest.approx(value, rel=1e-9)


def test_block_delayed_ewma_long_series_uses_carry(spark):
    # 2,000 bars -> 200 blocks > one chunk (154 blocks at alpha 0.2): exercises the carry path.
    rnd = random.Random(11)
    rows = [(1, b, rnd.uniform(-5, 5)) for b in range(1, 2001)] + [(2, b, 1.0) for b in range(1, 31)]
    df = spark.createDataFrame(rows, "trade_id long, bar_num long, profit double")
    out = seq.block_delayed_ewma(df, ["trade_id"], "bar_num", "profit").collect()
    expected = _brute_ewma(rows)
    for r in out:
        e = expected[(r.trade_id, r.bar_num)]
        assert (r.ewma is None) if e is None else r.ewma == pytest.approx(e, rel=1e-9, abs=1e-12)


def test_recursive_smoothing(spark):
    rows = [(1, b, float(v)) for b, v in enumerate([1, 1, 1], start=1)]
    df = spark.createDataFrame(rows, "t long, b long, y double")
    got = sorted((r.b, r.level) for r in seq.recursive_smoothing(df, ["t"], "b", "y", 0.2).collect())
    assert [round(x, 6) for _, x in got] == [0.2, 0.36, 0.488]


def test_level_chained_discount_cases(spark):
    # F-5: cost 100, 9 % at level 1 and 9 % at level 2 -> 9.00, 8.19; a second
    # 9 % coupon at level 2 -> 8.19 each; level gap 1 -> 3; level sum of 1.
    rows = [(1, "a", 1, 0.09, 100.0), (1, "b", 2, 0.09, 100.0),
            (2, "a", 1, 0.09, 100.0), (2, "b", 2, 0.09, 100.0), (2, "c", 2, 0.09, 100.0), (2, "d", 3, 0.5, 100.0),
            (3, "a", 1, 0.10, 50.0), (3, "b", 3, 0.20, 50.0),
            (4, "a", 1, 0.6, 10.0), (4, "b", 1, 0.4, 10.0), (4, "c", 2, 0.3, 10.0)]
    df = spark.createDataFrame(rows, "idx long, coupon_id string, level int, pct double, cost double")
    out = {(r.idx, r.coupon_id): (round(r.previous_deductions, 6), round(r.coupon_discount, 6))
           for r in seq.level_chained_discount(df, ["idx"], "level", "pct", "cost").collect()}
    assert out[(1, "a")] == (0.0, 9.0) and out[(1, "b")] == (9.0, 8.19)
    assert out[(2, "b")] == out[(2, "c")] == (9.0, 8.19)
    assert out[(2, "d")] == (round(100 - 91 * 0.82, 6), round(0.5 * 91 * 0.82, 6))
    assert out[(3, "b")] == (5.0, 9.0)
    assert out[(4, "c")] == (10.0, 0.0)
    # property: total deductions never exceed cost when level sums are <= 1
    for (idx, _), (prev, disc) in out.items():
        assert prev + disc <= 100.0 + 1e-9


def test_running_total_global_and_keyed(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), i, float(rnd.randint(0, 9))) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(4)
    glob = {r.t: r.running_total for r in seq.running_total(df, [], ["t"], "v", split_rows=60).collect()}
    keyed = {r.t: r.running_total for r in seq.running_total(df, ["k"], ["t"], "v", split_rows=60).collect()}
    acc, acc_k = 0.0, {"a": 0.0, "b": 0.0}
    for k, t, v in sorted(rows, key=lambda x: x[1]):
        acc += v
        acc_k[k] += v
        assert glob[t] == acc and keyed[t] == acc_k[k]


def test_ewma_plan_has_no_python_or_cartesian(spark):
    rows, df = _bars_fixture(spark)
    out = seq.block_delayed_ewma(df, ["trade_id"], "bar_num", "profit")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert np.isfinite(len(plan))
