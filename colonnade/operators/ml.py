"""Model operators (M1-M15) and the model jobs.

Estimators are ``pyspark.ml`` stages, which train distributed.  Evaluation
metrics are DataFrame aggregates (one row), so they compose with other plans
and never loop over rows on the driver; tests check them against the
``pyspark.ml.evaluation`` evaluators.  The only driver loops are over model
configurations (walk-forward periods, the two model kinds).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.operators.sequences import running_total
from colonnade.sources.sinks import persist_for_reuse

SEED = 42
# Partitions that a walk-forward window keeps at least.
LEAST_PARTITIONS = 8


def prep_stages(categorical: Sequence[str], numeric: Sequence[str], features: str = "features",
                handle_invalid: str = "keep") -> list:
    """M1 + M2 + M3: index categories by frequency, one-hot them (an unseen
    category gets its own slot), assemble with the numeric columns."""
    idx = [f"{c}_idx" for c in categorical]
    vec = [f"{c}_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid=handle_invalid,
                                    stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=vec, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*vec, *numeric], outputCol=features, handleInvalid="keep"))
    return stages


def fit_prep(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
             features: str = "features", handle_invalid: str = "keep") -> PipelineModel:
    """M8: fit the preparation once and share it between models (instead of
    refitting identical indexers inside every pipeline).

    ``handle_invalid='keep'`` lets held-out rows carry categories unseen in
    training (one extra slot per feature); ``'error'`` is the indexer default,
    with which k categories give exactly k one-hot slots."""
    return Pipeline(stages=prep_stages(categorical, numeric, features, handle_invalid)).fit(df)


def linear_regression(label: str, features: str = "features") -> LinearRegression:
    """M4."""
    return LinearRegression(featuresCol=features, labelCol=label)


def random_forest_regressor(label: str, features: str = "features", num_trees: int = 20) -> RandomForestRegressor:
    """M5 (seeded)."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, seed=SEED)


def gbt_classifier(label: str, features: str = "features", max_iter: int = 20) -> GBTClassifier:
    """M6 (seeded)."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, seed=SEED)


def random_forest_classifier(label: str, features: str = "features", num_trees: int = 20) -> RandomForestClassifier:
    """M7 (seeded)."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, seed=SEED)


# ---- metrics as one-row DataFrames -------------------------------------------

def rmse(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M9: root mean squared error (the regression evaluator's default metric)."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """M11."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def mape(df: DataFrame, label: str, prediction: str = "prediction", offset: float = 0.1,
         abs_denominator: bool = False) -> DataFrame:
    """Mean of |y - p| / y with y := label + offset, applied once to both
    terms (D18); a zero denominator gives null and is skipped."""
    y = F.col(label).cast("double") + F.lit(offset)
    den = F.abs(y) if abs_denominator else y
    return df.agg(F.avg(F.try_divide(F.abs(y - F.col(prediction).cast("double")), den)).alias("mape"))


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (ties count one half; null when
    only one class is present).

    Counts of positives/negatives per distinct score (partial aggregation),
    a distributed running total of negatives over the sorted scores, then
    ``sum(pos * (neg_below + neg_equal / 2)) / (P * N)``.
    """
    per_score = df.groupBy(score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("double").alias("_neg"))
    cum = running_total(per_score, [], [score], "_neg", "_neg_upto")
    return cum.agg(
        F.try_divide(F.sum(F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") * 0.5)),
                     F.sum("_pos") * F.sum("_neg")).alias("auc"))


def metric_frame(spark: SparkSession, rows: Sequence[tuple[str, str, float]]) -> DataFrame:
    """K6: (model, metric, value) rows -- a handful of scalars, never data."""
    schema = T.StructType([T.StructField("model", T.StringType()), T.StructField("metric", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(list(rows), schema)


def feature_importances(spark: SparkSession, model, transformed: DataFrame,
                        features: str = "features") -> DataFrame:
    """(idx, feature, importance) of the slots a tree model uses, most important first.

    Slot names (the feature column's metadata) and the model's importances are two small frames, one row a slot, joined by
    slot."""
    named = [(slot["idx"], slot["name"]) for kind in transformed.schema[features].metadata["ml_attr"]["attrs"].values() for slot in kind]
    weights = model.featureImportances.toArray().tolist()
    names = spark.createDataFrame(named, "idx int, feature string")
    scores = spark.createDataFrame(list(enumerate(weights)), "idx int, importance double")
    return names.join(scores, "idx").filter("importance <> 0").orderBy(F.desc("importance"), "idx")


def best_split(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The best first split of a tree over categories, exactly: one row (feature, value, gain, error), ties by
    feature and value.

    A split parts the rows with ``feature = value`` from the rest.  ``gain`` is the fall of the label's variance (for a 0/1 label half
    the fall of the Gini impurity), ``error`` the mean squared error that is left.  Counts, sums and squares per (feature,
    value) are one aggregation, combined in every task; trees of depth 1 over all features must choose the same."""
    y = F.col(label).cast("double")
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features]))
    sums = [F.count(y).alias("k"), F.sum(y).alias("s"), F.sum(y * y).alias("q")]
    per = df.filter(y.isNotNull()).select(y.alias("_y"), cells.alias("_c")).select("_y", "_c.*").groupBy("feature", "value").agg(
        F.count("_y").alias("k"), F.sum("_y").alias("s"))
    whole = df.agg(*sums).select(F.lit(1).alias("_one"), F.col("k").alias("n"), F.col("s").alias("t"), F.col("q"))
    both = per.withColumn("_one", F.when(F.col("k") > 0, 1)).join(whole.withColumn("_one", F.when(F.col("n") >= 0, 1)), "_one")
    rest_k, rest_s = F.col("n") - F.col("k"), F.col("t") - F.col("s")
    explained = F.col("s") * F.col("s") / F.col("k") + rest_s * rest_s / rest_k
    scored = both.filter(rest_k > 0).select(
        "feature", "value", ((explained - F.col("t") * F.col("t") / F.col("n")) / F.col("n")).alias("gain"),
        ((F.col("q") - explained) / F.col("n")).alias("error"))
    return scored.orderBy(F.desc("gain"), "feature", "value").limit(1)


def first_split(spark: SparkSession, model, transformed: DataFrame, features: str = "features") -> tuple[str, str]:
    """(feature, value) of a depth-1 tree model over one-hot slots named ``<feature>_vec_<value>``."""
    top = feature_importances(spark, model, transformed, features).first()
    feature, value = top["feature"].split("_vec_", 1)
    return feature, value


def vector_slots(df: DataFrame, vec: str, prefix: str, width: int) -> list[Column]:
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(f"{prefix}{i}") for i in range(width)]


# ---- model jobs ---------------------------------------------------------------

def weekly_forecast(data: DataFrame, is_test: str, categorical: Sequence[str], numeric: Sequence[str], label: str,
                    naive: str, out_path: str | None = None,
                    keep: Sequence[str] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One shared preparation, a linear and a random-forest regressor, and the ``naive`` column as a forecast
    to beat; RMSE of each on the rows with ``is_test``.  Returns (metrics, predictions by model);
    with ``out_path`` each model's (``keep`` columns, prediction, label) rows
    are also written as a CSV folder ``out_path/<model>`` (K1).

    The marked frame is persisted once; training and test rows are filters on it."""
    spark = data.sparkSession
    data = persist_for_reuse(data)
    train, test = data.filter(~F.col(is_test)), data.filter(F.col(is_test))
    prep = fit_prep(train, categorical, numeric)
    tr, te = prep.transform(train), prep.transform(test)
    preds, rows = {}, [("naive", "rmse", rmse(test, label, naive).first()[0])]
    for name, est in (("linear", linear_regression(label)), ("random_forest", random_forest_regressor(label))):
        model = est.fit(tr)
        p = model.transform(te)
        preds[name] = p
        rows.append((name, "rmse", rmse(p, label).first()[0]))
        if out_path:
            p.select(*keep, "prediction", label).write.mode("overwrite").csv(f"{out_path.rstrip('/')}/{name}")
    data.unpersist()
    return metric_frame(spark, rows), preds


def majority_accuracy(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always saying the most frequent label: what a classifier has to beat."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.try_divide(F.max("_n").cast("double"), F.sum("_n").cast("double")).alias("accuracy"))


def classification_drivers(df: DataFrame, categorical: Sequence[str], label: str,
                           kind: str = "gbt") -> tuple[DataFrame, DataFrame]:
    """Classifier on categorical drivers; (metrics, importances)."""
    spark = df.sparkSession
    data = StringIndexer(inputCol=label, outputCol="label_idx").fit(df).transform(df)
    prep = fit_prep(data, categorical, [])
    feats = persist_for_reuse(prep.transform(data).select("label_idx", "features"))
    est = gbt_classifier("label_idx") if kind == "gbt" else random_forest_classifier("label_idx")
    model = est.fit(feats)
    pred = model.transform(feats)
    prob1 = vector_to_array(F.col("probability"))[1]
    auc = area_under_roc(pred.select("label_idx", prob1.alias("score")), "label_idx", "score").first()[0]
    acc = accuracy(pred, "label_idx").first()[0]
    metrics = metric_frame(spark, [(kind, "auc", auc), (kind, "accuracy", acc),
                                   ("majority", "accuracy", majority_accuracy(feats, "label_idx").first()[0])])
    importances = feature_importances(spark, model, pred)
    feats.unpersist()
    return metrics, importances


def ewma_forecast(features: DataFrame, feature_cols: Sequence[str], label: str, is_test: str) -> DataFrame:
    """C11: random forest on the delayed-EWMA feature set, fitted on the rows without ``is_test`` and scored with MAPE
    on the later ones, next to the training mean as a forecast.  Returns a (model, metric, value) frame."""
    spark = features.sparkSession
    data = persist_for_reuse(features)
    train, test = data.filter(~F.col(is_test)), data.filter(F.col(is_test))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features",
                                            handleInvalid="keep"),
                            random_forest_regressor(label)])
    scored = mape(pipe.fit(train).transform(test), label).first()[0]
    constant = mape(test.withColumn("prediction", F.lit(train.agg(F.avg(label)).first()[0])), label).first()[0]
    data.unpersist()
    return metric_frame(spark, [("random_forest", "mape", scored), ("mean", "mape", constant)])


def walk_forward_windows(df: DataFrame, period: str, label: str, train_len: int, step: int) -> DataFrame:
    """M15's windows, from the data: (start, test_period, n_train, n_test, majority).

    Windows of ``train_len`` training periods and one test period start every ``step`` periods from the first period on, and the
    last one ends with the last period; ``majority`` is the accuracy on the test period of the training rows' most
    frequent label (ties: the greater label).  Every row goes to the few windows that hold it; one aggregation counts."""
    span = df.agg(F.min(period).cast("bigint").alias("_lo"), (F.max(period) - train_len).cast("bigint").alias("_hi"))
    starts = span.filter("_lo <= _hi").select(F.explode(F.array_distinct(F.concat(
        F.sequence("_lo", "_hi", F.lit(step).cast("bigint")), F.array("_hi")))).alias("start"))
    at = starts.select("start", F.explode(F.sequence(F.col("start"), F.col("start") + train_len)).alias("_p"))
    counts = df.groupBy(F.col(period).cast("bigint").alias("_p"), F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    rows = at.join(counts, "_p").withColumn("_test", F.col("_p") == F.col("start") + train_len)
    per = rows.groupBy("start", "_label").agg(F.sum(F.when(~F.col("_test"), F.col("_n")).otherwise(0)).alias("_tr"),
                                              F.sum(F.when(F.col("_test"), F.col("_n")).otherwise(0)).alias("_te"))
    best = F.max(F.struct("_tr", "_label", "_te"))
    out = per.groupBy("start").agg(F.sum("_tr").alias("n_train"), F.sum("_te").alias("n_test"), best.alias("_b"))
    return out.select("start", (F.col("start") + train_len).alias("test_period"), "n_train", "n_test",
                      F.try_divide(F.col("_b._te").cast("double"), F.col("n_test").cast("double")).alias("majority"))


def walk_forward(df: DataFrame, period: str, train_len: int, categorical: Sequence[str], label: str,
                 step: int | None = None, parallel: int = 4) -> DataFrame:
    """In every window of :func:`walk_forward_windows` (by default the windows share no period but, at the end, those that the
    last one needs) fit a classifier on the training periods and test it on the next one.  Returns the windows with ``accuracy``
    (null without training or test rows).

    The fits are independent jobs; at most ``parallel`` run at once.  The driver loops over windows, never over rows.  A fit runs
    some fifteen jobs, and every task of them reports to the driver: where the data has more than ``LEAST_PARTITIONS`` partitions, a
    window's rows are dealt once to as many as their share of the data (in a fixed order, so that reruns agree)."""
    spark = df.sparkSession
    columns = [period, label, *categorical]
    data = persist_for_reuse(df.select(*columns))
    windows = walk_forward_windows(data, period, label, train_len, step or train_len + 1).collect()  # one row a window
    parts, total = data.select(F.spark_partition_id().alias("_part")).agg(F.max("_part") + 1, F.count(F.lit(1))).first()

    def fit(w) -> tuple:
        accuracy_ = None
        if w["n_train"] and w["n_test"]:
            rows = data.filter(F.col(period).between(w["start"], w["test_period"]))
            share = max(LEAST_PARTITIONS, -(-parts * (w["n_train"] + w["n_test"]) // total))
            if dealt := share < parts:
                rows = persist_for_reuse(rows.repartition(share).sortWithinPartitions(*columns))
            train = rows.filter(F.col(period) < w["test_period"])
            test = rows.filter(F.col(period) == w["test_period"])
            pipe = Pipeline(stages=[*prep_stages(categorical, []), random_forest_classifier(label)])
            accuracy_ = accuracy(pipe.fit(train).transform(test), label).first()[0]
            if dealt:
                rows.unpersist()
        return (*w, accuracy_)

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(fit, windows))
    data.unpersist()
    return spark.createDataFrame(sorted(rows), "start long, test_period long, n_train long, n_test long, majority double, accuracy double")
