"""Queries on the climate cube write no cube: it is derived while they read it."""

import pytest

from habiflow.plans import fixtures as FX

ON_THE_CUBE = ["raster_sel_nearest", "raster_slice_range", "src_raster_scan", "raster_annual_features", "raster_coarsen",
               "raster_dim_mean", "raster_from_wide", "sink_resume_append", "stream_enrich"]


@pytest.mark.parametrize("name", ON_THE_CUBE)
def test_no_cube_is_stored(spark, sf_small, monkeypatch, name):
    import __spark_entry__ as E
    stored, write = [], FX.materialize
    monkeypatch.setattr(FX, "materialize", lambda spark, name, *a, **kw: (stored.append(name), write(spark, name, *a, **kw))[1])
    assert E.queries()[name](spark, sf_small).columns
    assert "raster" not in stored
