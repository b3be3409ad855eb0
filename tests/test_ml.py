"""Model stages and evaluators (M1-M13) against pyspark.ml evaluators."""

import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.sql import functions as F

from colonnade.operators import ml


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(9)
    rows = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 30)), float(rnd.randint(0, 1))) for _ in range(400)]
    return spark.createDataFrame(rows, "label double, score double, prediction double")


def test_auc_matches_evaluator(spark, scored):
    ours = ml.area_under_roc(scored, "label", "score").first()[0]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored)
    assert ours == pytest.approx(ev, abs=1e-12)


def test_accuracy_and_rmse_match_evaluators(spark, scored):
    acc = ml.accuracy(scored, "label").first()[0]
    assert acc == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored))
    rmse = ml.rmse(scored, "score", "prediction").first()[0]
    assert rmse == pytest.approx(RegressionEvaluator(labelCol="score").evaluate(scored))


def test_mape_offset_once(spark):
    df = spark.createDataFrame([(0.0, 0.1), (9.9, 5.0), (-0.1, 1.0)], "profit double, prediction double")
    got = ml.mape(df, "profit").first()[0]
    # y = profit + 0.1: 0.1 -> 0/0.1 = 0; 10 -> 0.5; 0 -> null (skipped)
    assert got == pytest.approx(0.25)


def test_one_hot_keep_gives_k_slots_and_importances(spark):
    rows = [("x" if i % 3 else "y", "p" if i % 2 else "q", float(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "a string, b string, label double")
    strict = ml.fit_prep(df, ["a", "b"], [], handle_invalid="error").transform(df)
    assert strict.select(F.size(ml.vector_to_array("features"))).first()[0] == 4
    prep = ml.fit_prep(df, ["a", "b"], [])
    feats = prep.transform(df)
    assert feats.select(F.size(ml.vector_to_array("features"))).first()[0] == 6
    unseen = spark.createDataFrame([("z", "p", 0.0)], "a string, b string, label double")
    assert prep.transform(unseen).count() == 1
    model = ml.gbt_classifier("label", max_iter=5).fit(feats)
    imp = ml.feature_importances(spark, model, model.transform(feats)).collect()
    assert imp and all(r.importance > 0 for r in imp)
    assert imp[0].feature.startswith("a_vec")


def test_linear_regression_recovers_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2.0) for x in range(20)], "x double, y double")
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = ml.linear_regression("y").fit(data)
    assert model.coefficients[0] == pytest.approx(3.0) and model.intercept == pytest.approx(2.0)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.5)], "label double, score double")
    assert ml.area_under_roc(df, "label", "score").first()[0] is None


def test_best_split_is_the_tree_s_split(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("xyz"), rnd.choice("pqrs"), rnd.choice(["k", None])) for _ in range(300)]
    rows = [(a, b, c, float(a == "x") * 3 + rnd.random()) for a, b, c in rows]
    df = spark.createDataFrame(rows, "a string, b string, c string, y double")
    got = ml.best_split(df, ["a", "b"], "y").first()

    def sse(v):
        return sum((x - sum(v) / len(v)) ** 2 for x in v) if v else 0.0
    want = min((sse([r[3] for r in rows if r[i] == v]) + sse([r[3] for r in rows if r[i] != v]), n, v)
               for i, n in ((0, "a"), (1, "b")) for v in {r[i] for r in rows})
    assert (got.feature, got.value) == want[1:] and got.error == pytest.approx(want[0] / 300)
    assert got.gain == pytest.approx((sse([r[3] for r in rows]) - want[0]) / 300)
    feats = ml.fit_prep(df, ["a", "b"], []).transform(df)
    model = ml.random_forest_regressor("y", num_trees=1).setFeatureSubsetStrategy("all").setBootstrap(False).setMaxDepth(1).fit(feats)
    assert ml.first_split(spark, model, feats) == (got.feature, got.value)
    assert ml.best_split(df.limit(0), ["a"], "y").count() == 0
    assert ml.best_split(df.where("a = 'x'"), ["a"], "y").count() == 0  # one value: nothing to part


def test_walk_forward_covers_every_period(spark):
    rows = [(p, "x" if i % 2 else "y", i % 2 if p % 5 else 1) for p in range(3, 34) for i in range(6)]
    df = spark.createDataFrame(rows, "period int, d string, y int")
    w = [tuple(r) for r in ml.walk_forward_windows(df, "period", "y", 4, 5).orderBy("start").collect()]
    starts = [3, 8, 13, 18, 23, 28, 29]
    assert [r[0] for r in w] == starts and all(r[1] == r[0] + 4 and r[2] == 24 and r[3] == 6 for r in w)
    covered = {p for s in starts for p in range(s, s + 5)}
    assert covered == set(range(3, 34))
    full = ml.walk_forward(df, "period", 4, ["d"], "y").collect()
    assert [r.start for r in full] == starts
    assert all(r.accuracy == 1.0 for r in full if r.test_period % 5) and {r.n_test for r in full} == {6}
    assert ml.walk_forward(df.where("period < 5"), "period", 4, ["d"], "y").count() == 0
    assert ml.walk_forward(df.where("period not in (7, 12)"), "period", 4, ["d"], "y").where("test_period in (7, 12) and accuracy is null").count() == 2


def test_walk_forward_windows_take_their_share_of_partitions(spark, monkeypatch):
    rows = [(p, "x" if i % 2 else "y", i % 2) for p in range(1, 41) for i in range(12)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 96), "period int, d string, y int")
    took, whole = [], ml.Pipeline.fit

    def spy(self, dataset, params=None):
        took.append(dataset.rdd.getNumPartitions())
        return whole(self, dataset, params)

    monkeypatch.setattr(ml.Pipeline, "fit", spy)
    got = ml.walk_forward(df, "period", 4, ["d"], "y").collect()
    assert len(took) == len(got) == 8 and max(took) <= 12  # five of forty periods, of 96 partitions
    assert all((r.n_train, r.n_test, r.accuracy) == (48, 12, 1.0) for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, ml.walk_forward(df, "period", 4, ["d"], "y").collect()))


def test_forecast_jobs_report_a_baseline(spark):
    rows = [(f"n{k}", w, float(10 * k + w % 3), float(10 * k + (w - 1) % 3), w == 29) for k in range(3) for w in range(30)]
    df = spark.createDataFrame(rows, "nation string, week int, n double, lag_1 double, is_test boolean")
    metrics, preds = ml.weekly_forecast(df, "is_test", ["nation"], ["lag_1"], "n", "lag_1")
    got = {r.model: r.value for r in metrics.collect()}
    assert set(got) == {"naive", "linear", "random_forest"} and got["naive"] == pytest.approx(1.0)
    assert preds["linear"].count() == 3
    assert ml.majority_accuracy(spark.createDataFrame([(1,), (1,), (0,)], "y int"), "y").first()[0] == pytest.approx(2 / 3)
