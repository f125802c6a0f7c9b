"""Many labels on one axis: windows that only grow, and ranges that hold as many rows however the values lie."""

import random

from pyspark.sql import functions as F

from habiflow.operators import raster as R


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_no_window_starts_anew_for_each_row(spark):
    axis = spark.range(50).select("id", (F.col("id") * 1.5).alias("x"))
    labels = spark.range(500).select((F.col("id") / 7).alias("label"))
    plan = _plan(R.nearest_on_axis(labels, "label", axis, "x", "id"))
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_ranges_follow_the_rows(spark):
    rng = random.Random(5)
    # most labels lie beyond the axis, and one breakpoint lies far off
    axis = [(k, k / 10) for k in range(100)] + [(100, 1e9)]
    labels = [(rng.uniform(50, 60),) for _ in range(5000)] + [(rng.uniform(-5, 10),) for _ in range(200)] + [(float("nan"),), (None,)]
    a, b = spark.createDataFrame(axis, "i int, x double"), spark.createDataFrame(labels, "label double")
    cuts = a.selectExpr("x as v").union(b).agg(F.percentile_approx("v", [k / 64 for k in range(1, 64)])).first()[0]
    ranges = b.groupBy(R.range_of(F.col("label"), sorted(set(cuts))).alias("b")).count()
    assert ranges.agg(F.max("count")).first()[0] < 300
    got = {r["label"]: r["i"] for r in R.nearest_on_axis(b, "label", a, "x", "i", 64).collect()}
    for (v,) in labels:
        if v is not None and v == v:
            assert got[v] == min((abs(x - v), i) for i, x in axis)[1]
    assert got[None] is None


def test_range_of_counts_the_cuts(spark):
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 7, 8, 1023):
        cuts = sorted(rng.uniform(0, 10) for _ in range(n))
        vs = [rng.uniform(-1, 11) for _ in range(50)] + cuts[:20] + [float("inf"), float("-inf")]
        got = spark.createDataFrame([(v,) for v in vs], "v double").select("v", R.range_of(F.col("v"), cuts).alias("b")).collect()
        assert all(r["b"] == sum(c <= r["v"] for c in cuts) for r in got)
