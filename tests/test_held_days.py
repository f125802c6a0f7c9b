"""Streams hold the cube's days once, dealt by cell: micro-batches shuffle their own points only."""

import re

import pytest
from pyspark.sql import functions as F

from habiflow import streaming as ST
from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX


def _points(cube):
    return cube.filter("itime in (2, 55, 100)").select(
        F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude"),
        F.date_add("time", 3).cast("timestamp").alias("datetime"))


def test_held_days_give_the_same_rows_and_are_not_shuffled_again(spark, sf_small):
    spec, cube = FX.raster_spec(spark, sf_small), FX.cube(spark, sf_small)
    held = R.held_days(cube, spec, ST.DAYS)
    try:
        pts = _points(cube).union(_points(cube).limit(5))  # some points twice
        a = R.nearest_cell_join(pts, cube, spec, days=ST.DAYS)
        b = R.nearest_cell_join(pts, held, spec, days=ST.DAYS)
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())) != []
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        pts = spark.createDataFrame(pts.limit(20).collect(), pts.schema)
        plan = R.nearest_cell_join(pts, held, spec, days=ST.DAYS)._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"InMemoryRelation.*?(?=\n\S|\Z)", "", plan, flags=re.S)
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        held.unpersist()


def test_held_days_keep_repeated_time_steps_and_leave_out_other_days(spark, sf_small):
    spec, cube = FX.raster_spec(spark, sf_small), FX.cube(spark, sf_small)
    twice = cube.unionByName(cube.filter("itime = 4")).unionByName(cube.filter("itime = 5").withColumns(
        {"itime": F.lit(None).cast("int"), "tblock": F.lit(None).cast("int")}))
    held = R.held_days(twice, spec, ("1979-01-22", "1979-02-15"))
    try:
        got = {r["itime"]: r["count"] for r in held.groupBy("itime").count().collect()}
        assert got[4] == 2 * spec.lat.size * spec.lon.size and got[5] * 2 == got[4] and None not in got
        assert min(got) == 3 and max(got) == 7
    finally:
        held.unpersist()


@pytest.mark.parametrize("name", ["stream_enrich", "sink_resume_append"])
def test_streams_join_held_days_and_let_them_go(spark, sf_small, monkeypatch, name):
    import __spark_entry__ as E
    joined, join = [], R.nearest_cell_join
    monkeypatch.setattr(R, "nearest_cell_join", lambda p, r, *a, **kw: (joined.append((r, r.is_cached)), join(p, r, *a, **kw))[1])
    assert E.queries()[name](spark, sf_small).count() > 0
    assert joined and all(cached for _, cached in joined) and not any(r.is_cached for r, _ in joined)
