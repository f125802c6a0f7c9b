"""Model statistics and Spark ML jobs.

Exact statistics (standardisation, Bernoulli naive Bayes, CV summaries) are
plain aggregates.  Learners are Spark ML estimators (distributed tree
building, MLP); the scikit-learn / XGBoost / Keras / AutoML models of the
reference are re-aimed at their Spark ML counterparts.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators.sampling import bucket_rank
from habiflow.session import cut_lineage

# --- fixed values that must equal the reference's (do not edit) ----------
NB_ALPHA = 10.0
GBT_STEP = 0.5
GBT_DEPTH = 3
GBT_ROUNDS = 100
GBT_MIN_CHILD_WEIGHT = 8
TEST_SIZE = 0.2
CV_FOLDS = 5
GAP_LIMIT = 0.05
CV_STD_LIMIT = 0.1
MLP_HIDDEN = (64, 32)
# Columns never used as features.
EXCLUDED = ("gbifID", "gridmet_lat", "gridmet_lon", "gridmet_date", "decimalLatitude", "decimalLongitude",
            "datetime", "parsed_datetime", "season", "month", "day")
# --------------------------------------------------------------------------


# This package's own identifiers and split columns, no features either.
OWN_COLUMNS = ("ord", "attempt", "is_test", "fold")


def standardize_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population std per feature (sklearn StandardScaler)."""
    wide = df.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
                  *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("std")) for i, f in enumerate(features)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def standardize(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Apply (x - mean) / std_pop with the stats (of ``fit_on``, ``df`` by default) broadcast as one row."""
    wide = (df if fit_on is None else fit_on).agg(*[F.avg(f).alias(f"__m_{f}") for f in features],
                  *[F.stddev_pop(f).alias(f"__s_{f}") for f in features])
    x = df.crossJoin(F.broadcast(wide))
    for f in features:
        x = x.withColumn(f, (F.col(f) - F.col(f"__m_{f}")) /
                         F.when(F.col(f"__s_{f}") > 0, F.col(f"__s_{f}")).otherwise(F.lit(1.0)))
    return x.drop(*[c for c in x.columns if c.startswith("__m_") or c.startswith("__s_")])


def bernoulli_nb_fit(df: DataFrame, features: Sequence[str], label: str,
                     alpha: float = NB_ALPHA) -> DataFrame:
    """theta[c, j] = (count(x_j > 0 in class c) + alpha) / (n_c + 2 alpha),
    uniform class prior; output (label, feature, theta)."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"),
                              *[F.sum((F.col(f) > 0).cast("int")).alias(f"__k{i}") for i, f in enumerate(features)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"),
                              ((F.col(f"__k{i}") + alpha) / (F.col("__n") + 2 * alpha)).alias("theta"))
                     for i, f in enumerate(features)])
    return g.select(label, F.explode(rows).alias("r")).select(label, "r.feature", "r.theta")


def bernoulli_nb_predict(df: DataFrame, theta: DataFrame, features: Sequence[str], label: str,
                         key: str) -> DataFrame:
    """Posterior P(class 1) with equal priors: log-likelihood sums per class,
    softmax over the two classes.  ``theta`` is tiny (classes x features)."""
    t = theta.groupBy(label).pivot("feature", list(features)).agg(F.first("theta"))
    t0 = t.filter(F.col(label) == 0).select(*[F.col(f).alias(f"__t0_{f}") for f in features])
    t1 = t.filter(F.col(label) == 1).select(*[F.col(f).alias(f"__t1_{f}") for f in features])
    x = df.crossJoin(F.broadcast(t0)).crossJoin(F.broadcast(t1))
    def ll(c: int) -> F.Column:
        s = F.lit(0.0)
        for f in features:
            b = (F.col(f) > 0).cast("double")
            th = F.col(f"__t{c}_{f}")
            s = s + b * F.log(th) + (1 - b) * F.log(1 - th)
        return s
    x = x.withColumn("__l0", ll(0)).withColumn("__l1", ll(1))
    p1 = 1.0 / (1.0 + F.exp(F.col("__l0") - F.col("__l1")))
    return x.select(key, p1.alias("nb_probability"), (p1 >= 0.5).cast("int").alias("nb_prediction"))


def cv_summary(df: DataFrame, fold: str, label: str, pred: str) -> DataFrame:
    """Per-fold accuracy -> mean, population std, mean -+ 2 std."""
    a = df.groupBy(fold).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("acc"))
    m, s = F.avg("acc"), F.stddev_pop("acc")
    return a.agg(F.round(m, 6).alias("cv_mean"), F.round(s, 6).alias("cv_std"),
                 F.round(m - 2 * s, 6).alias("cv_low"), F.round(m + 2 * s, 6).alias("cv_high"),
                 F.count(F.lit(1)).alias("folds"))


def overfit_verdict(split: DataFrame, folds: DataFrame, label: str, pred: str) -> DataFrame:
    """Train-test gap vs 0.05 and CV std vs 0.1."""
    hit = (F.col(label) == F.col(pred)).cast("double")
    tt = split.agg(F.avg(F.when(~F.col("is_test"), hit)).alias("train_acc"),
                   F.avg(F.when(F.col("is_test"), hit)).alias("test_acc"))
    cv = (folds.groupBy("fold").agg(F.avg(hit).alias("acc")).agg(F.stddev_pop("acc").alias("cv_std")))
    x = tt.crossJoin(cv)
    gap = F.col("train_acc") - F.col("test_acc")
    return x.select(F.round("train_acc", 6).alias("train_accuracy"), F.round("test_acc", 6).alias("test_accuracy"),
                    F.round(gap, 6).alias("gap"), F.round("cv_std", 6).alias("cv_std"),
                    F.when(gap > GAP_LIMIT, "overfitting").otherwise("ok").alias("gap_verdict"),
                    F.when(F.col("cv_std") > CV_STD_LIMIT, "unstable").otherwise("stable").alias("cv_verdict"))


# ------------------------------------------------------------ Spark ML ----

def feature_columns(df: DataFrame, target: str = "occurrence",
                    excluded: Sequence[str] = EXCLUDED + OWN_COLUMNS) -> list[str]:
    """Numeric columns minus target and excluded names."""
    num = ("double", "float", "int", "bigint", "smallint")
    return [f.name for f in df.schema.fields
            if f.name != target and f.name not in excluded and f.dataType.simpleString() in num]


def require_features(df: DataFrame, features: Sequence[str]) -> None:
    """Presence gate before scoring."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")


def _assembler(features: Sequence[str]) -> list:
    return [VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def random_forest(features: Sequence[str], label: str = "occurrence", trees: int = 100,
                  depth: int = 8, seed: int = 42) -> Pipeline:
    """K3: assembler -> scaler -> random forest."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=_assembler(features) + [rf])


def boosted_trees(features: Sequence[str], label: str = "occurrence", rounds: int = GBT_ROUNDS,
                  seed: int = 42) -> Pipeline:
    """K4 first stage: gradient-boosted trees (step 0.5, depth 3; min child
    weight 8 mapped to minInstancesPerNode)."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=GBT_DEPTH,
                        stepSize=GBT_STEP, minInstancesPerNode=GBT_MIN_CHILD_WEIGHT, seed=seed)
    return Pipeline(stages=_assembler(features) + [gbt])


def mlp(features: Sequence[str], label: str = "occurrence", hidden: Sequence[int] = MLP_HIDDEN,
        max_iter: int = 100, seed: int = 42) -> Pipeline:
    """Multilayer perceptron d-64-32-2 on scaled features."""
    m = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label,
                                       layers=[len(features), *hidden, 2], maxIter=max_iter, seed=seed)
    return Pipeline(stages=_assembler(features) + [m])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """K5: append ``prediction`` (int) and ``probability`` = P(class 1)."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def importances(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """K6: feature importance table (zeros when the model has none)."""
    last = model.stages[-1]
    vals = list(getattr(last, "featureImportances", [0.0] * len(features)))
    rows = [(f, float(vals[i]) if i < len(vals) else 0.0) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double")


def evaluate(pred: DataFrame, label: str = "occurrence") -> dict:
    """Accuracy of a scored frame (one aggregate; returns a small dict)."""
    r = pred.agg(F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("a")).collect()[0]
    return {"accuracy": float(r["a"]) if r["a"] is not None else None}


# ------------------------------------------------- folds, curves, grids ----

CURVE_STEPS = 10   # training sizes of a learning curve: tenths of a fold's training rows
SIDE_BY_SIDE = 4   # fits that run at a time; each is a distributed job of its own
HELD_ROWS = 4_000_000   # training rows that fits at a time hold: each keeps its own copy, in memory or on disk


def _each(df: DataFrame, fits: Sequence, run, share: Callable | None = None) -> list:
    """``run`` of every element, in the order given; driver threads only submit Spark jobs.

    Fits on ``df``, or on the ``share`` of its rows that each takes, run some at
    a time, of many rows one: it keeps the cluster busy, and copies side by side
    would fill the executors' disks.
    """
    rows, free, turn = df.count(), [HELD_ROWS], threading.Condition()

    def held(fit):
        need = min(HELD_ROWS, math.ceil(rows * (share(fit) if share else 1)))
        with turn:
            turn.wait_for(lambda: free[0] >= need)
            free[0] -= need
        try:
            return run(fit)
        finally:
            with turn:
                free[0] += need
                turn.notify_all()

    with ThreadPool(SIDE_BY_SIDE) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(held), list(fits), chunksize=1)


def out_of_fold(df: DataFrame, pipes: dict[str, Pipeline], key: str, label: str = "occurrence", fold: str = "fold",
                folds: int = CV_FOLDS) -> DataFrame:
    """K7: one table ``model, fold, part, key, label, prediction, probability``.

    For every model and fold, fitted on the rows of the other folds, the
    predictions of all rows: ``part`` is 'test' for the rows of the fold and
    'train' for the others.
    """
    def one(what: tuple[str, int]) -> DataFrame:
        name, k = what
        fitted = pipes[name].fit(df.filter(F.col(fold) != k))
        part = F.when(F.col(fold) == k, "test").otherwise("train")
        return (score(fitted, df, [key, label, fold])
                .select(F.lit(name).alias("model"), F.lit(k).alias("fold"), part.alias("part"), key, label, "prediction", "probability"))

    return reduce(DataFrame.unionByName, _each(df, [(n, k) for n in pipes for k in range(folds)], one))


def fold_scores(oof: DataFrame, label: str = "occurrence") -> DataFrame:
    """K7: sizes, accuracies and train-test gap of every model and fold, in one aggregation."""
    hit = (F.col(label) == F.col("prediction")).cast("double")
    of = lambda part, x: F.when(F.col("part") == part, x)
    return (oof.groupBy("model", "fold").agg(
        F.count(of("train", F.lit(1))).alias("n_train"), F.count(of("test", F.lit(1))).alias("n_test"),
        F.avg(of("train", hit)).alias("train_accuracy"), F.avg(of("test", hit)).alias("test_accuracy"))
        .withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy")))


def model_scores(scores: DataFrame) -> DataFrame:
    """K7/K9: mean test accuracy +- 2 std over the folds, mean gap and its verdict for each model."""
    m, s, gap = F.avg("test_accuracy"), F.stddev_pop("test_accuracy"), F.avg("gap")
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("folds"), m.alias("cv_mean"), s.alias("cv_std"), (m - 2 * s).alias("cv_low"), (m + 2 * s).alias("cv_high"),
        F.avg("train_accuracy").alias("train_accuracy"), gap.alias("gap"),
        F.when(gap > GAP_LIMIT, "overfitting").otherwise("ok").alias("gap_verdict"),
        F.when(s > CV_STD_LIMIT, "unstable").otherwise("stable").alias("cv_verdict"))


def curve_rows(df: DataFrame, key: str, fold: str = "fold", folds: int = CV_FOLDS, steps: int = CURVE_STEPS) -> DataFrame:
    """K8: a copy of each row for every fold ``held`` that it isn't in, with ``step``: the first of ``steps``
    nested training sets of that fold that it belongs to.

    The sets of a fold are the first floor(n * step / steps) of its n training
    rows by hash rank, so each holds all smaller ones.
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col(fold))
    x = df.select("*", F.explode(others).alias("held")).withColumn("__u", H.uniform("curve", key))
    r = bucket_rank(x, "__u", key, by=["held"])
    ends = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda s: F.floor(F.col("group_n") * s / steps))
    first = F.size(F.filter(ends, lambda e: e <= F.col("rank"))) + 1
    return r.withColumn("step", first).drop("__u", "rank", "group_n")


def learning_curve(df: DataFrame, pipe: Pipeline, key: str, label: str = "occurrence", fold: str = "fold",
                   folds: int = CV_FOLDS, steps: int = CURVE_STEPS) -> DataFrame:
    """K8: ``step, n_train, train_mean, train_std, test_mean, test_std`` over the folds; ``n_train`` is their mean."""
    rows = cut_lineage(curve_rows(df, key, fold, folds, steps))

    def one(what: tuple[int, int]) -> DataFrame:
        k, step = what
        # a fit passes over its rows some five times, and scores them
        train = rows.filter((F.col("held") == k) & (F.col("step") <= step)).drop("held", "step").persist()
        fitted = pipe.fit(train)
        both = train.select(*df.columns, F.lit("train").alias("part")).unionByName(
            df.filter(F.col(fold) == k).withColumn("part", F.lit("test")))
        hit = (F.col(label) == F.col("prediction")).cast("double")
        each = cut_lineage(score(fitted, both, [label, "part"]).groupBy("part").agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))
                           .withColumns({"fold": F.lit(k), "step": F.lit(step)}))
        train.unpersist()
        return each

    each = reduce(DataFrame.unionByName, _each(df, [(k, s) for s in range(1, steps + 1) for k in range(folds)], one, lambda w: w[1] / steps))
    acc = {p: F.when(F.col("part") == p, F.col("accuracy")) for p in ("train", "test")}
    return each.groupBy("step").agg(
        F.avg(F.when(F.col("part") == "train", F.col("n"))).alias("n_train"),
        *[f(acc[p]).alias(f"{p}_{n}") for p in ("train", "test") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def save_model(model: PipelineModel, features: Sequence[str], path: str) -> None:
    """A fitted model and the list of its features."""
    model.write().overwrite().save(f"{path}/model")
    (SparkSession.getActiveSession().createDataFrame([(i, f) for i, f in enumerate(features)], "place int, feature string")
     .coalesce(1).write.mode("overwrite").json(f"{path}/features"))


def load_model(spark, path: str) -> tuple[PipelineModel, list[str]]:
    """What :func:`save_model` wrote."""
    rows = spark.read.schema("place int, feature string").json(f"{path}/features").orderBy("place").collect()  # a row a feature
    return PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows]
