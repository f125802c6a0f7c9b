"""Cube conversions, slices by partition, labels on uneven axes, run lookups."""

import random

import pytest
from pyspark.sql import functions as F

from habiflow.operators import raster as R
from habiflow.operators import reports as RP
from habiflow.plans import fixtures as FX


def test_wide_and_back(spark):
    cube = spark.createDataFrame([(t, i, j, float(100 * t + 10 * i + j)) for t in range(3) for i in range(2) for j in range(4)],
                                 "itime int, ilat int, ilon int, v double")
    back = R.from_wide(R.to_wide(cube, "v"), "v")
    assert sorted(map(tuple, back.select(cube.columns).collect())) == sorted(map(tuple, cube.collect()))
    d = R.density(back, ["itime", "ilat", "ilon"]).first()
    assert (d["n_rows"], d["n_cells"], d["n_repeated"], d["dense"]) == (24, 24, 0, True)
    assert not R.density(back.filter("ilon <> 2 or itime <> 1"), ["itime", "ilat", "ilon"]).first()["dense"]
    assert R.density(back.union(back.limit(1)), ["itime", "ilat", "ilon"]).first()["n_repeated"] == 1
    with pytest.raises(ValueError, match="no columns"):
        R.from_wide(cube.select("itime", "v"), "v")


def test_labels_on_an_uneven_axis_equal_brute_force(spark):
    rng = random.Random(2)
    axis = sorted({round(rng.choice([rng.uniform(0, 1), rng.uniform(0, 1000)]), 2) for _ in range(200)} | {10.0, 20.0, 5000.0})
    places = list(range(len(axis)))
    rng.shuffle(places)
    labels = [rng.uniform(-50, 6000) for _ in range(300)] + [15.0, 15.0, 10.0, None, axis[0] - 1, axis[-1] + 1]
    a = spark.createDataFrame(list(zip(places, axis)), "i int, x double")
    b = spark.createDataFrame([(v,) for v in labels], "label double")
    for buckets in (1, 7, 1024):
        got = {r["label"]: (r["i"], r["x"]) for r in R.nearest_on_axis(b, "label", a, "x", "i", buckets).collect()}
        assert len(got) == len(set(labels))
        for v in labels:
            want = (None, None) if v is None else min((abs(x - v), i, x) for i, x in zip(places, axis))[1:]
            assert got[v] == want, v
    assert R.nearest_on_axis(b, "label", a.limit(0), "x", "i").filter("i IS NOT NULL").count() == 0


def test_slices_read_their_partitions_only(spark, sf_small):
    spec, cube = FX.raster_spec(spark, sf_small), FX.raster(spark, sf_small)
    for one in (R.slice_time(cube, month="1980-02", spec=spec), R.slice_time(cube, "1979-03-01", "1979-06-30", spec=spec), R.latest_slice(cube)):
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "tblock" in "".join(p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:])
    for kw in ({"month": "1980-02"}, {"start": "1979-12-25", "end": "1980-01-10"}, {"start": "1981-01-01"}):
        assert sorted(map(tuple, R.slice_time(cube, spec=spec, **kw).select("itime", "ilat", "ilon").collect())) == \
            sorted(map(tuple, R.slice_time(cube, **kw).select("itime", "ilat", "ilon").collect()))
    last = cube.agg(F.max("itime")).first()[0]
    assert {r[0] for r in R.latest_slice(cube).select("itime").distinct().collect()} == {last}
    a, b = R.axes_extent(cube).first().asDict(), R.raster_extent(cube).first().asDict()
    assert a == {k: b[k] for k in a}


def test_run_lookups(spark):
    runs = spark.createDataFrame([(1, "a", 0.5), (2, "a", 0.7), (3, "b", 0.9)], "version_id int, model_name string, accuracy double")
    log = spark.createDataFrame([("a", 1, "2020-01-01"), ("a", 2, "2020-02-01"), ("a", 1, "2020-03-01"), ("b", 9, "2020-01-15")],
                                "model_name string, version_id int, day string").select("model_name", "version_id", F.to_timestamp("day").alias("set_at"))
    now = {r["model_name"]: (r["version_id"], r["accuracy"]) for r in RP.current_runs(runs, log).collect()}
    assert now == {"a": (1, 0.5), "b": (9, None)}
    then = {r["model_name"]: r["version_id"] for r in RP.current_runs(runs, log, "2020-02-15").collect()}
    assert then == {"a": 2, "b": 9}
    assert {r["model_name"] for r in RP.current_runs(runs, log, "2020-01-10").collect()} == {"a"}
    ids = spark.createDataFrame([(2,), (7,), (2,)], "version_id int")
    assert {(r["version_id"], r["found"]) for r in RP.runs_by_id(runs, ids).collect()} == {(2, True), (7, False)}
    docs = spark.createDataFrame([(2, '{"accuracy": 0.7, "f1": {"0": 0.1, "1": 0.2}, "note": "text"}'), (3, "{}")], "version_id int, metrics string")
    got = {(r["metric"], r["value"]) for r in RP.metrics_by_id(docs, ids).collect()}
    assert got == {("accuracy", 0.7), ("f1.0", 0.1), ("f1.1", 0.2), ("note", None)}


def test_models_that_are_missing(spark):
    i = spark.createDataFrame([("a", "x", 0.5), ("a", "y", 0.7), ("b", "x", 0.1)], "model string, feature string, importance double")
    assert {(r["model"], r["feature"]) for r in RP.compare_models(i, ["a", "c"], 1).collect()} == {("a", "y")}
    assert [r[0] for r in RP.missing_models(i, ["a", "c"]).collect()] == ["c"]
