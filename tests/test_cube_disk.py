"""The climate cube is derived while it is read: same rows as the stored form, nothing stored, no shuffle by time step."""

import re

import pytest
from pyspark.sql import functions as F

from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX


def test_the_cube_has_the_stored_rows(spark, sf_small):
    a, b = FX.cube(spark, sf_small), FX.raster(spark, sf_small)
    assert sorted(a.columns) == sorted(b.columns)
    a, b = a.select(b.columns), b
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("name", ["raster_slice", "fn_cell_area", "srt_latest_slice", "flagship_seasonal_climate"])
def test_queries_store_no_cube(spark, sf_small, monkeypatch, name):
    import __spark_entry__ as E
    stored, write = [], FX.materialize
    monkeypatch.setattr(FX, "materialize", lambda spark, name, *a, **kw: (stored.append(name), write(spark, name, *a, **kw))[1])
    assert E.queries()[name](spark, sf_small).count() > 0
    assert "raster" not in stored


def _exchanges(df):
    return re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_what_groups_by_time_step_is_not_shuffled(spark, sf_small, monkeypatch):
    monkeypatch.setattr(FX, "STEPS_PER_TASK", 40)
    cube = FX.cube(spark, sf_small)
    spec = FX.raster_spec(spark, sf_small)
    wide = R.to_wide(cube, "air_temperature", list(range(spec.lon.size)))
    for df in (wide, R.coarsen(cube, ["air_temperature"], 3, 3), R.weighted_mean(cube, "air_temperature", spec, by=["itime"])):
        assert _exchanges(df) == ["rangepartitioning"]


def test_known_days_bound_what_a_join_reads_and_not_its_rows(spark, sf_small):
    spec, cube = FX.raster_spec(spark, sf_small), FX.cube(spark, sf_small)
    day = F.to_date(F.col("time"))
    pts = cube.filter("itime in (2, 55, 100)").select(F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude"),
                                                      F.date_add(day, 3).cast("timestamp").alias("datetime"))
    ends = pts.agg(F.date_format(F.min("datetime"), "yyyy-MM-dd"), F.date_format(F.max("datetime"), "yyyy-MM-dd")).first()
    a, b = (sorted(map(str, R.nearest_cell_join(pts, cube, spec, days=d).collect())) for d in (None, tuple(ends)))
    assert a == b and a
