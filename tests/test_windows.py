"""Time windows and per-entity windows (W1-W4, M14), decisions D11-D13."""

import datetime as dt

from pyspark.sql import functions as F

from colonnade.operators import windows as win


def test_weekly_windows_are_epoch_aligned(spark):
    rows = [(1, dt.datetime(2001, 1, 1, 12), "0833", "8"), (2, dt.datetime(2001, 1, 3, 23), "0833", "8"),
            (3, dt.datetime(2001, 1, 4, 1), "0833", "8")]
    df = spark.createDataFrame(rows, "ID long, Date timestamp_ntz, Beat string, District string")
    out = win.tumbling_count(df, "Date", ["Beat", "District"], "ID").collect()
    got = sorted((r.window.start.isoformat(), r.event_count) for r in out)
    # 2001-01-01 falls in the Thursday-aligned week starting 2000-12-28.
    assert got == [("2000-12-28T00:00:00", 2), ("2001-01-04T00:00:00", 1)]


def test_lag_counts_rows_and_breaks_ties(spark):
    # A missing week is not filled; D13: two districts of one beat are ordered by district.
    rows = [("b1", "d1", 1, 7), ("b1", "d1", 2, 3), ("b1", "d1", 4, 2), ("b1", "d2", 4, 5)]
    df = spark.createDataFrame(rows, "beat string, district string, week int, n long")
    out = win.lag_features(df, ["beat"], ["week", "district"], "n", {"lag_1": 1, "lag_2": 2})
    got = [(r.week, r.district, r.lag_1, r.lag_2) for r in out.orderBy("week", "district").collect()]
    assert got == [(1, "d1", None, None), (2, "d1", 7, None), (4, "d1", 3, 7), (4, "d2", 2, 3)]


def test_latest_and_rest_partition_the_rows(spark):
    rows = [("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 5, 50)] + [("hot", i, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    train, test = win.split_last_per_entity(df, ["k"], ["t"])
    assert sorted((r.k, r.t) for r in test.collect()) == [("a", 3), ("b", 5), ("hot", 199)]
    assert train.count() + test.count() == df.count()
    assert train.join(test, ["k", "t"]).count() == 0


def test_latest_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = win.latest_per_group(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_keys_behave_like_window_groups(spark):
    from pyspark.sql import Window

    from colonnade.operators.joins import attach_group_aggregate
    rows = [(None, 1, 1.0), (None, 2, 3.0), ("a", 1, 5.0), ("a", 2, 7.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    rest = sorted((r.k, r.t) for r in win.all_but_latest(df, ["k"], ["t"]).collect() if r.k is not None)
    assert rest == [("a", 1)]
    assert sorted((r.k or "", r.t) for r in win.all_but_latest(df, ["k"], ["t"]).collect()) == [("", 1), ("a", 1)]
    means = sorted((r.k or "", r.t, r.group_mean) for r in attach_group_aggregate(df, ["k"], "v").collect())
    ref = sorted((r.k or "", r.t, r.m) for r in df.withColumn("m", F.avg("v").over(Window.partitionBy("k"))).collect())
    assert means == ref


def test_densify_fills_missing_weeks(spark):
    rows = [("b1", dt.datetime(2001, 1, 4), 3), ("b1", dt.datetime(2001, 1, 18), 5), ("b2", dt.datetime(2001, 1, 4), 1)]
    df = spark.createDataFrame(rows, "beat string, week timestamp_ntz, n long")
    out = win.densify_periods(df, ["beat"], "week", "n")
    got = sorted((r.beat, r.week.day, r.n) for r in out.collect())
    assert got == [("b1", 4, 3), ("b1", 11, 0), ("b1", 18, 5), ("b2", 4, 1)]


def test_write_range_buckets(spark, tmp_dir):
    import os
    from colonnade.operators.ordering import range_bucket_partition
    from colonnade.sources.sinks import write_range_buckets
    df = spark.createDataFrame([(w, 1) for w in ["anvil", "gear", "lamp", "ring", "widget"]], "artist string, n int")
    out = os.path.join(tmp_dir, "b")
    write_range_buckets(range_bucket_partition(df, "artist"), out, "artist")
    assert sorted(d for d in os.listdir(out) if d.startswith("bucket=")) == [f"bucket={i}" for i in range(5)]


def test_calendar_lags_by_week_and_year(spark):
    import datetime as dt

    from colonnade.operators import windows as win
    t0 = dt.datetime(2020, 1, 2)
    have = {0: 5, 1: 6, 3: 7, 52: 8, 55: 9}
    rows = [("a", t0 + dt.timedelta(days=7 * w), n) for w, n in have.items()] + [("b", t0, 1), (None, t0, 2)]
    df = spark.createDataFrame(rows, "k string, week timestamp_ntz, n long")
    got = win.calendar_lags(df, ["k"], "week", "n", {"lag_1": 1, "lag_52": 52}).where("k = 'a'").orderBy("week").collect()
    full = [have.get(w, 0) for w in range(56)]
    assert [r.n for r in got] == full
    assert [r.lag_1 for r in got] == [None, *full[:-1]] and [r.lag_52 for r in got] == [None] * 52 + full[:4]
    plan = win.calendar_lags(df, ["k"], "week", "n", {"lag_52": 52})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_mark_last_agrees_with_the_split(spark):
    from colonnade.operators import windows as win
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 2), ("b", 5, 1), (None, 1, 1), (None, 3, 1)], "k string, t int, id int")
    marked = win.mark_last_per_entity(df, ["k"], ["t", "id"])
    assert sorted((str(r.k), r.t, r.id) for r in marked.where("is_last").collect()) == [("None", 3, 1), ("a", 2, 2), ("b", 5, 1)]
    train, test = win.split_last_per_entity(df, ["k"], ["t", "id"])
    assert train.count() == 3 and test.count() == 3 and train.columns == df.columns
