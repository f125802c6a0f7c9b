"""A join whose rows' first and last day are known reads its points once: no pass finds the blocks that they hit."""

import pytest
from pyspark.sql import functions as F

from habiflow import streaming as ST
from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX

DAYS = ("1979-01-10", "1980-12-31")


def _points(spark):
    return spark.sql("""SELECT id, 25.0D + id AS decimalLatitude, -124.0D + 2 * id AS decimalLongitude,
                        timestamp_seconds(unix_seconds(TIMESTAMP '1979-01-10') + id * 86400 * 34) AS datetime FROM range(22)
                        UNION ALL SELECT 90, 40.0D, -100.0D, NULL UNION ALL SELECT 91, NULL, -100.0D, TIMESTAMP '1979-02-01'""")


def test_no_pass_over_the_points(spark, sf_small):
    spec = FX.raster_spec(spark, sf_small)
    pts = _points(spark).withColumn("id", F.raise_error(F.lit("read")).cast("bigint")).withColumn(
        "datetime", F.when(F.col("id") >= 0, F.col("datetime")))
    assert "gridmet_date" in R.nearest_cell_join(pts, FX.cube(spark, sf_small), spec, days=DAYS).columns


@pytest.mark.parametrize("few", [0, 100_000])
def test_same_rows_shuffled_or_broadcast(spark, sf_small, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_CELLS", few)
    spec, cube, pts = FX.raster_spec(spark, sf_small), FX.cube(spark, sf_small), _points(spark)
    a, b = (R.nearest_cell_join(pts, cube, spec, days=d) for d in (None, DAYS))
    assert ("BroadcastHashJoin" in b._jdf.queryExecution().executedPlan().toString()) == bool(few)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() > 5


@pytest.mark.parametrize("name", ["flagship_seasonal_climate", "join_nearest_cell", "ml_yield_score"])
def test_queries_on_cleaned_rows_know_their_days(spark, sf_small, monkeypatch, name):
    import __spark_entry__ as E
    known, join = [], R.nearest_cell_join
    monkeypatch.setattr(R, "nearest_cell_join", lambda *a, **kw: (known.append(kw.get("days")), join(*a, **kw))[1])
    assert E.queries()[name](spark, sf_small).columns
    assert known == [ST.DAYS]
