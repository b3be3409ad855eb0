"""Registered queries: model stages, evaluators and model jobs (M1-M15, C5,
C6, C11, K6).  Evaluators with a deterministic predictor have oracles; model
fits are checked on row counts (and in the tests against brute force)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.operators import ml
from colonnade.operators import sequences as seq
from colonnade.operators import windows as win
from colonnade.plans.common import r6, table, ts_text
from colonnade.plans.q_sequences import NATION_WEEKS_SQL, YEAR_LAGS, nation_weeks
from colonnade.plans.registry import register
from colonnade.session import scratch_path
from colonnade.sources import sinks


@register("ml_string_index", """
SELECT event_type, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, event_type ASC) - 1 AS DOUBLE) AS idx
FROM events GROUP BY event_type
""")
def ml_string_index(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type")
    indexed = ml.fit_prep(e, ["event_type"], [], handle_invalid="error").transform(e)
    return indexed.select("event_type", F.col("event_type_idx").alias("idx")).distinct()


@register("ml_one_hot", """
SELECT event_type, CAST(idx AS DOUBLE) AS idx, CAST(idx AS INTEGER) AS slot, CAST(width AS INTEGER) AS width FROM (
  SELECT event_type, row_number() OVER (ORDER BY COUNT(*) DESC, event_type ASC) - 1 AS idx,
         COUNT(*) OVER () AS width
  FROM events GROUP BY event_type) t
""")
def ml_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """M2: with ``handleInvalid='keep'`` k categories give k slots (the extra
    slot for unseen values is the one dropped as last)."""
    e = table(spark, sf, "events").select("event_type")
    coded = ml.fit_prep(e, ["event_type"], [], handle_invalid="error").transform(e)
    out = coded.select("event_type", F.col("event_type_idx").alias("idx"), vector_to_array("event_type_vec").alias("arr")).distinct()
    return out.select("event_type", "idx", (F.array_position("arr", F.lit(1.0)) - 1).cast("int").alias("slot"),
                      F.size("arr").alias("width"))


@register("ml_assemble", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem
""")
def ml_assemble(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    vec = VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(li)
    return vec.select("l_orderkey", "l_linenumber", *ml.vector_slots(vec, "features", "f", 3))


@register("ml_linear_regression", """
SELECT ROUND(REGR_SLOPE(l_extendedprice, l_quantity), 4) AS slope,
       ROUND(REGR_INTERCEPT(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem
""")
def ml_linear_regression(spark: SparkSession, sf: str) -> DataFrame:
    """M4: one-feature least squares; the fitted line equals SQL's regression aggregates."""
    li = table(spark, sf, "lineitem")
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(li)
    model = ml.linear_regression("l_extendedprice").fit(data)
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))],
                                 "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


def _weekly_features(spark: SparkSession, sf: str) -> DataFrame:
    weekly = win.tumbling_count(table(spark, sf, "events"), "ts", ["user_id"], "event_id", out="n")
    weekly = weekly.select("user_id", F.col("window.start").alias("week"), F.col("n").cast("double").alias("n"))
    lagged = win.lag_features(weekly, ["user_id"], ["week"], "n", {"lag_1": 1, "lag_2": 2})
    return lagged.withColumn("user", F.col("user_id").cast("string"))


_WEEKLY_LAG_SQL = """
WITH w AS (SELECT user_id, time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS week,
                  CAST(COUNT(event_id) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
l AS (SELECT user_id, week, n, lag(n, 1) OVER (PARTITION BY user_id ORDER BY week) AS lag_1 FROM w)
"""


@register("eval_rmse", _WEEKLY_LAG_SQL + """
SELECT ROUND(SQRT(AVG((n - lag_1) * (n - lag_1))), 6) AS rmse FROM l WHERE lag_1 IS NOT NULL
""")
def eval_rmse(spark: SparkSession, sf: str) -> DataFrame:
    """M9 on the naive forecast "same as last week"."""
    f = _weekly_features(spark, sf).filter(F.col("lag_1").isNotNull())
    return ml.rmse(f, "n", "lag_1").select(r6("rmse").alias("rmse"))


@register("eval_mape", _WEEKLY_LAG_SQL + """
SELECT ROUND(AVG(ABS((n + 0.1) - lag_1) / (n + 0.1)), 6) AS mape FROM l WHERE lag_1 IS NOT NULL
""")
def eval_mape(spark: SparkSession, sf: str) -> DataFrame:
    """M13 on the naive forecast."""
    f = _weekly_features(spark, sf).filter(F.col("lag_1").isNotNull())
    return ml.mape(f, "n", "lag_1").select(r6("mape").alias("mape"))


_SCORED_SQL = """
WITH s AS (SELECT l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score FROM labels l JOIN documents d USING (doc_id))
"""


@register("eval_auc", _SCORED_SQL + """
SELECT ROUND(SUM(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END)
             / ((SELECT COUNT(*) FROM s WHERE label = 1) * (SELECT COUNT(*) FROM s WHERE label = 0)), 6) AS auc
FROM (SELECT score FROM s WHERE label = 1) p, (SELECT score FROM s WHERE label = 0) n
""")
def eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Document length as a score for the quality label."""
    scored = (table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
              .select(F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score")))
    return ml.area_under_roc(scored, "label", "score").select(r6("auc").alias("auc"))


@register("eval_accuracy", _SCORED_SQL + """
SELECT ROUND(AVG(CASE WHEN (CASE WHEN score >= 5000 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM s
""")
def eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """The rule "long documents are good" against the quality label."""
    scored = (table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
              .select(F.col("quality").alias("label"),
                      F.when(F.col("n_chars") >= 5000, 1).otherwise(0).alias("prediction")))
    return ml.accuracy(scored, "label").select(r6("accuracy").alias("accuracy"))


_DRIVERS = ["priority", "segment", "month", "day_of_week", "nation"]


def _order_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """Arrest-style classification frame: label = order finished, drivers =
    priority, segment, month, day of week, nation (all categorical)."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    j = o.join(c, "o_custkey")
    return j.select(
        "o_orderkey", F.col("o_totalprice").alias("price"),
        F.when((F.month("o_orderdate") == 12) | ((F.col("o_orderpriority") == "1-URGENT") & (F.dayofweek("o_orderdate") == 1)), 1).otherwise(0).alias("peak"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.dayofweek("o_orderdate").cast("string").alias("day_of_week"),
        F.col("c_nationkey").cast("string").alias("nation"))


def _classify(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    data = _order_drivers(spark, sf)
    prep = ml.fit_prep(data, _DRIVERS, [])
    feats = prep.transform(data).select("o_orderkey", "finished", "features")
    est = ml.gbt_classifier("finished") if kind == "gbt" else ml.random_forest_classifier("finished")
    return est.fit(feats).transform(feats).select("o_orderkey", "finished", "prediction")


@register("ml_gbt_classify")
def ml_gbt_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classify(spark, sf, "gbt")


@register("ml_rf_classify")
def ml_rf_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classify(spark, sf, "rf")


def _nation_features(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly orders per nation with their calendar lags, a year back included (rows with all lags)."""
    lagged = win.calendar_lags(nation_weeks(spark, sf), ["nation"], "week", "n", YEAR_LAGS).na.drop(subset=list(YEAR_LAGS))
    return lagged.select("week", F.col("nation").cast("string").alias("nation"), *[F.col(c).cast("double").alias(c) for c in ("n", *YEAR_LAGS)])


@register("ml_rf_regression")
def ml_rf_regression(spark: SparkSession, sf: str) -> DataFrame:
    """M5: random forest on weekly lags (rows with all lags)."""
    f = _nation_features(spark, sf)
    prep = ml.fit_prep(f, ["nation"], list(YEAR_LAGS))
    feats = prep.transform(f)
    pred = ml.random_forest_regressor("n").fit(feats).transform(feats)
    return pred.select("nation", ts_text("week").alias("week_start"), "n", "prediction")


_DRIVER_SQL = """
WITH o AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y, o_totalprice AS price, o_orderpriority AS priority,
             CASE WHEN month(o_orderdate) = 12 OR (o_orderpriority = '1-URGENT' AND dayofweek(o_orderdate) = 0) THEN 1.0 ELSE 0.0 END AS peak,
             c_mktsegment AS segment, CAST(month(o_orderdate) AS VARCHAR) AS month,
             CAST(dayofweek(o_orderdate) + 1 AS VARCHAR) AS day_of_week, CAST(c_nationkey AS VARCHAR) AS nation
           FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _split_sql(target: str) -> str:
    """The best one-value split on ``target``, with the sums on both sides."""
    cells = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS value, {target} AS v FROM o" for f in _DRIVERS)
    return f"""{_DRIVER_SQL},
p AS (SELECT feature, value, COUNT(*) AS k, SUM(v) AS s FROM ({cells}) c GROUP BY 1, 2),
w AS (SELECT COUNT(*) AS n, SUM({target}) AS t, SUM({target} * {target}) AS q FROM o),
g AS (SELECT feature, value, k, s, n, t, q, s * s / k + (t - s) * (t - s) / (n - k) AS explained FROM p, w WHERE n > k),
b AS (SELECT * FROM g ORDER BY explained DESC, feature, value LIMIT 1)"""


@register("best_split_class", _split_sql("y") + """
SELECT feature, value, ROUND((explained - t * t / n) / n, 9) AS gain, ROUND((q - explained) / n, 9) AS error FROM b
""")
def best_split_class(spark: SparkSession, sf: str) -> DataFrame:
    """M6 / M7: the exact first split on the class, from counts."""
    return ml.best_split(_order_drivers(spark, sf), _DRIVERS, "finished").select("feature", "value", r6("gain", 9).alias("gain"), r6("error", 9).alias("error"))


_STUMP_ACCURACY_SQL = """
SELECT feature, value, ROUND((GREATEST(s, k - s) + GREATEST(t - s, n - k - (t - s))) / n, 9) AS accuracy FROM b
"""


def _stump(spark: SparkSession, sf: str, est, label: str) -> tuple[DataFrame, tuple[str, str]]:
    """Predictions and first split of a one-tree, depth-1 model over all features and rows."""
    data = _order_drivers(spark, sf)
    feats = sinks.persist_for_reuse(ml.fit_prep(data, _DRIVERS, []).transform(data).select(label, "features"))
    model = est.setMaxDepth(1).fit(feats)
    return model.transform(feats), ml.first_split(spark, model, feats)


def _one_tree(est):
    return est.setNumTrees(1).setFeatureSubsetStrategy("all").setSubsamplingRate(1.0).setBootstrap(False)


def _stump_accuracy(pred: DataFrame, split: tuple[str, str], label: str) -> DataFrame:
    acc = ml.accuracy(pred, label)
    return acc.select(F.lit(split[0]).alias("feature"), F.lit(split[1]).alias("value"), r6("accuracy", 9).alias("accuracy"))


@register("ml_stump_rf", _split_sql("peak") + _STUMP_ACCURACY_SQL)
def ml_stump_rf(spark: SparkSession, sf: str) -> DataFrame:
    """M7 with one tree of depth 1 over all rows and features: its split and accuracy must be the exact ones.  (The label
    is one whose sides differ in their majority: the forest drops splits that change no prediction.)"""
    return _stump_accuracy(*_stump(spark, sf, _one_tree(ml.random_forest_classifier("peak")), "peak"), "peak")


@register("ml_stump_gbt", _split_sql("y") + _STUMP_ACCURACY_SQL)
def ml_stump_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """M6 after one round of depth 1: the same split."""
    return _stump_accuracy(*_stump(spark, sf, ml.gbt_classifier("finished", max_iter=1).setFeatureSubsetStrategy("all"), "finished"), "finished")


@register("ml_stump_regression", _split_sql("price") + """
SELECT feature, value, ROUND(SQRT((q - explained) / n), 4) AS rmse FROM b
""")
def ml_stump_regression(spark: SparkSession, sf: str) -> DataFrame:
    """M5 with one tree of depth 1: the exact split of the order price and what error it leaves."""
    pred, split = _stump(spark, sf, _one_tree(ml.random_forest_regressor("price")), "price")
    return ml.rmse(pred, "price").select(F.lit(split[0]).alias("feature"), F.lit(split[1]).alias("value"), r6("rmse", 4).alias("rmse"))


@register("ml_stump_importance", _split_sql("peak") + """
SELECT feature || '_vec_' || value AS feature, 1.0 AS importance FROM b
""")
def ml_stump_importance(spark: SparkSession, sf: str) -> DataFrame:
    """M12 on a depth-1 tree: the split's slot has all importance."""
    data = _order_drivers(spark, sf)
    feats = ml.fit_prep(data, _DRIVERS, []).transform(data)
    model = _one_tree(ml.random_forest_classifier("peak")).setMaxDepth(1).fit(feats)
    return ml.feature_importances(spark, model, feats).select("feature", "importance")


@register("majority_baseline", _DRIVER_SQL + """
SELECT ROUND(GREATEST(SUM(y), COUNT(*) - SUM(y)) / COUNT(*), 9) AS accuracy FROM o
""")
def majority_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """The accuracy the drivers jobs report next to their models'."""
    return ml.majority_accuracy(_order_drivers(spark, sf), "finished").select(r6("accuracy", 9).alias("accuracy"))


@register("ml_feature_importance")
def ml_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """M12 / C6 (GBT variant): named non-zero importances."""
    _, importances = ml.classification_drivers(_order_drivers(spark, sf), _DRIVERS, "finished", "gbt")
    return importances


@register("job_classification_drivers")
def job_classification_drivers(spark: SparkSession, sf: str) -> DataFrame:
    """GBT and random-forest variants; AUC and accuracy of each."""
    data = _order_drivers(spark, sf)
    gbt, _ = ml.classification_drivers(data, _DRIVERS, "finished", "gbt")
    rf, _ = ml.classification_drivers(data, _DRIVERS, "finished", "rf")
    return gbt.unionByName(rf)


def _forecast_data(spark: SparkSession, sf: str) -> DataFrame:
    return win.mark_last_per_entity(_nation_features(spark, sf), ["nation"], ["week"], "is_test")


@register("job_weekly_forecast")
def job_weekly_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly counts, lags of one, two and 52 weeks, last week per entity held out, linear vs forest vs last week's count."""
    metrics, _ = ml.weekly_forecast(_forecast_data(spark, sf), "is_test", ["nation"], list(YEAR_LAGS), "n", "lag_1",
                                    out_path=scratch_path(spark, "weekly-predictions"), keep=["nation"])
    return metrics


_FORECAST_SQL = f"""
WITH w AS ({NATION_WEEKS_SQL}),
s AS (SELECT nation, MIN(week) AS lo, MAX(week) AS hi FROM w GROUP BY 1),
g AS (SELECT nation, hi, unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS week FROM s),
d AS (SELECT g.nation, g.hi, g.week, COALESCE(w.n, 0) AS n FROM g LEFT JOIN w ON g.nation = w.nation AND g.week = w.week),
l AS (SELECT d.*, a.n AS lag_1 FROM d JOIN d a ON a.nation = d.nation AND a.week = d.week - INTERVAL 7 DAY
      JOIN d y ON y.nation = d.nation AND y.week = d.week - INTERVAL 364 DAY)
"""


@register("weekly_forecast_baseline", _FORECAST_SQL + """
SELECT COUNT(*) FILTER (WHERE week < hi) AS n_train, COUNT(*) FILTER (WHERE week = hi) AS n_test,
       ROUND(SQRT(AVG((n - lag_1) * (n - lag_1)) FILTER (WHERE week = hi)), 9) AS naive_rmse FROM l
""")
def weekly_forecast_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """C5's rows and the error of its naive forecast, which the job reports next to the models'."""
    d = _forecast_data(spark, sf)
    naive = ml.rmse(d.filter("is_test"), "n", "lag_1").scalar()
    return d.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if(F.col("is_test")).alias("n_test")).withColumn("naive_rmse", F.round(naive, 9))


@register("metric_report")
def metric_report(spark: SparkSession, sf: str) -> DataFrame:
    """K6: the C5 metrics written as a JSON report and read back."""
    metrics, _ = ml.weekly_forecast(_forecast_data(spark, sf), "is_test", ["nation"], list(YEAR_LAGS), "n", "lag_1")
    path = scratch_path(spark, "metrics")
    sinks.write_report(metrics, path, "json")
    return spark.read.schema(metrics.schema).json(path)


@register("metric_report_counts", """
SELECT 'events' AS model, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM events
UNION ALL SELECT 'events', 'mean_value', ROUND(AVG(value), 6) FROM events
UNION ALL SELECT 'events', 'users', CAST(COUNT(DISTINCT user_id) AS DOUBLE) FROM events
""")
def metric_report_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K6 with metrics that SQL can check: long (model, metric, value) rows through the JSON report."""
    e = table(spark, sf, "events").agg(F.count(F.lit(1)).cast("double").alias("rows"), F.round(F.avg("value"), 6).alias("mean_value"),
                                       F.count_distinct("user_id").cast("double").alias("users"))
    cells = F.explode(F.array(*[F.struct(F.lit("events").alias("model"), F.lit(c).alias("metric"), F.col(c).alias("value")) for c in e.columns]))
    path = scratch_path(spark, "metric-counts")
    sinks.write_report(e.select(cells.alias("_c")).select("_c.*"), path, "json")
    return spark.read.schema("model string, metric string, value double").json(path)


def _ewma_features(spark: SparkSession, sf: str) -> DataFrame:
    """Bars with their delayed EWMA; the last fifth of the time span is held out."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type")
    bars = seq.dense_ordinal(e, ["user_id"], ["ts", "event_id"], "bar")
    feats = seq.block_delayed_ewma(bars, ["user_id"], "bar", "value", 0.2, 10, how="inner")
    span = e.agg(F.min("ts").alias("lo"), F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("len"))
    cut = span.select(F.timestamp_add("SECOND", F.floor(F.col("len") * 4 / 5).cast("int"), F.col("lo"))).scalar()
    return feats.select("value", "ewma", "weight_mass", F.hour("ts").cast("double").alias("hour"),
                        F.dayofweek("ts").cast("double").alias("dow"), (F.col("ts") >= cut).alias("is_test"))


@register("job_ewma_forecast")
def job_ewma_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """C11: delayed-EWMA feature per bar plus calendar features -> forest -> MAPE on the later bars."""
    return ml.ewma_forecast(_ewma_features(spark, sf), ["ewma", "weight_mass", "hour", "dow"], "value", "is_test")


@register("ewma_forecast_baseline", """
WITH b AS (SELECT value, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS bar FROM events),
s AS (SELECT MIN(ts) + to_seconds(CAST(floor(date_diff('microsecond', MIN(ts), MAX(ts)) // 1000000 * 4 / 5) AS BIGINT)) AS cut FROM events),
f AS (SELECT value, ts >= cut AS is_test FROM b, s WHERE bar > 10),
m AS (SELECT AVG(value) AS m FROM f WHERE NOT is_test)
SELECT COUNT(*) FILTER (WHERE NOT is_test) AS n_train, COUNT(*) FILTER (WHERE is_test) AS n_test,
       ROUND(AVG(ABS((value + 0.1) - m) / NULLIF(value + 0.1, 0)) FILTER (WHERE is_test), 6) AS mean_mape FROM f, m
""")
def ewma_forecast_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """C11's training and held-out rows and the error of the mean as a forecast."""
    f = _ewma_features(spark, sf)
    mean = f.filter(~F.col("is_test")).agg(F.avg("value")).scalar()
    error = ml.mape(f.filter("is_test").withColumn("prediction", mean), "value").scalar()
    return f.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if(F.col("is_test")).alias("n_test")).withColumn("mean_mape", F.round(error, 6))


# Fixed values of the test mapping: months of training per window.
TRAIN_MONTHS = 6


def _monthly_drivers(spark: SparkSession, sf: str) -> DataFrame:
    data = _order_drivers(spark, sf).join(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return data.withColumn("period", (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate"))


@register("walk_forward_windows", f"""
WITH o AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS p
           FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT MIN(p) AS lo, MAX(p) - {TRAIN_MONTHS} AS hi FROM o),
s AS (SELECT DISTINCT start FROM (SELECT unnest(generate_series(lo, hi, {TRAIN_MONTHS + 1})) AS start FROM r UNION ALL SELECT hi FROM r) t),
c AS (SELECT s.start, SUM(CASE WHEN p < s.start + {TRAIN_MONTHS} THEN 1 ELSE 0 END) AS n_train,
        SUM(CASE WHEN p = s.start + {TRAIN_MONTHS} THEN 1 ELSE 0 END) AS n_test,
        SUM(CASE WHEN p < s.start + {TRAIN_MONTHS} THEN y ELSE 0 END) AS ones,
        SUM(CASE WHEN p = s.start + {TRAIN_MONTHS} THEN y ELSE 0 END) AS test_ones
      FROM s JOIN o ON p BETWEEN s.start AND s.start + {TRAIN_MONTHS} GROUP BY 1)
SELECT CAST(start AS BIGINT) AS start, CAST(start + {TRAIN_MONTHS} AS BIGINT) AS test_period, CAST(n_train AS BIGINT) AS n_train,
       CAST(n_test AS BIGINT) AS n_test,
       ROUND(CASE WHEN 2 * ones >= n_train THEN test_ones ELSE n_test - test_ones END / n_test, 9) AS majority FROM c
""")
def walk_forward_windows(spark: SparkSession, sf: str) -> DataFrame:
    """M15's windows over the whole calendar: their rows, and the majority label's accuracy in each test month."""
    w = ml.walk_forward_windows(_monthly_drivers(spark, sf), "period", "finished", TRAIN_MONTHS, TRAIN_MONTHS + 1)
    return w.withColumn("majority", r6("majority", 9))


@register("ml_walk_forward")
def ml_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Train on six months, test on the next, in windows that cover all months."""
    return ml.walk_forward(_monthly_drivers(spark, sf), "period", TRAIN_MONTHS, _DRIVERS, "finished")
