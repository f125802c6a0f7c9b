"""The train and score jobs: gates, outputs, folds and saved models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from habiflow.operators import clean as C
from habiflow.operators import jobs as J
from habiflow.operators import model as M
from habiflow.operators import sampling as SM


@pytest.fixture(scope="module")
def table(spark):
    rows = [(f"r{i}", i % 2, 40.0 + i / 100, -110.0, 2000.0 + i % 5, 1.0 + i % 12, 1.0, dt.datetime(2000, 1, 1), float(i % 2) + (i % 7) / 10, float(i % 3))
            for i in range(120)]
    t = spark.createDataFrame(rows, "row_key string, occurrence int, decimalLatitude double, decimalLongitude double, year double, month double, "
                                    "day double, datetime timestamp, a double, b double")
    return SM.stratified_folds(SM.train_test_split(t, "row_key"), "occurrence", "row_key").cache()


def test_validation_is_a_gate(spark, table):
    assert J.require_valid(table, ["a"]) is table
    with pytest.raises(ValueError, match="month_range: 120"):
        J.require_valid(table.withColumn("month", F.lit(13.0)), [])
    with pytest.raises(ValueError, match="year_nulls: 60"):
        J.require_valid(table.withColumn("year", F.when(F.col("occurrence") == 1, F.col("year"))), [])
    with pytest.raises(ValueError, match="expected_columns: 1"):
        J.require_valid(table, ["a", "nowhere"])


def test_modeling_projection_warns(table):
    with pytest.warns(UserWarning, match="season_num"):
        m, missing = C.modeling_columns(table, ["a"])
    assert missing == ["season_num"] and m.columns[-1] == "a" and "b" not in m.columns
    with pytest.raises(ValueError, match="no target"):
        C.modeling_columns(table.drop("occurrence"), ["a"])


def test_train_and_score_write_their_outputs(spark, table, tmp_path):
    out = str(tmp_path / "run")
    with pytest.warns(UserWarning):
        run = J.train(spark, table, ["a", "b"], ["a", "b"], out).first()
    assert (run["n_train"], run["n_test"], run["missing_columns"], run["top_features"][0]) == (96, 24, 1, "a")
    assert spark.read.option("header", True).csv(f"{out}/enriched").columns[-2:] == ["a", "b"]
    report = spark.read.option("header", True).csv(f"{out}/importance").collect()
    assert [(r["model"], r["feature"], r["rank"]) for r in sorted(report, key=lambda r: r["rank"])] == [("random_forest", "a", "1"), ("random_forest", "b", "2")]
    model, features = M.load_model(spark, f"{out}/model")
    assert features == ["a", "b"]
    s = J.score(spark, model, table.withColumn("ord", F.xxhash64("row_key")), str(tmp_path / "score"), 0.6).first()
    pred = spark.read.parquet(str(tmp_path / "score/predictions"))
    assert s["total_coordinates"] == 120 == pred.count() and s["suitable_habitat_count"] == pred.filter("probability >= 0.6").count()
    assert spark.read.parquet(str(tmp_path / "score/markers")).count() == 120
    assert spark.read.parquet(str(tmp_path / "score/histogram")).agg(F.sum("n")).first()[0] == 120


def test_importance_report_leaves_unknown_models_out(spark, table):
    fitted = M.random_forest(["a", "b"], trees=3, depth=2).fit(table)
    got = J.importance_report({"x": (fitted, ["a", "b"])}, spark, ["x", "y"]).collect()
    assert {r["model"] for r in got} == {"x"} and len(got) == 2
    assert J.importance_report({}, spark).count() == 0


def test_out_of_fold_and_curve(spark, table):
    pipe = M.random_forest(["a", "b"], trees=3, depth=2)
    oof = M.out_of_fold(table, {"m": pipe}, "row_key", folds=5)
    assert oof.count() == 600 and oof.filter("part = 'test'").select("row_key").distinct().count() == 120
    scores = M.fold_scores(oof).collect()
    assert {(r["n_train"], r["n_test"]) for r in scores} == {(96, 24)} and all(r["test_accuracy"] == 1.0 for r in scores)
    one = M.model_scores(M.fold_scores(oof)).first()
    assert (one["folds"], one["cv_mean"], one["gap_verdict"], one["cv_verdict"]) == (5, 1.0, "ok", "stable")
    rows = M.curve_rows(table, "row_key").groupBy("held", "step").count().collect()
    sizes = {}
    for r in rows:
        for s in range(r["step"], 11):
            sizes[r["held"], s] = sizes.get((r["held"], s), 0) + r["count"]
    assert sizes == {(k, s): 96 * s // 10 for k in range(5) for s in range(1, 11)}
    curve = {r["step"]: r for r in M.learning_curve(table, pipe, "row_key", folds=5, steps=2).collect()}
    assert curve[1]["n_train"] == 48 and curve[2]["n_train"] == 96 and curve[2]["test_mean"] == 1.0
