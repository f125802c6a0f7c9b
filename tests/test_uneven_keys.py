"""Operators whose keys or values are uneven: against brute force, and without one long task."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from habiflow.operators import dictionary as D
from habiflow.operators import geocode as G
from habiflow.operators import quality as Q
from habiflow.operators import sampling as SM


def test_describe_of_several_columns_matches_pandas(spark):
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.1 else 7.0 if rng.random() < 0.9 else rng.gauss(0, 50), rng.choice([-0.0, 0.0, 1e100, -2.5, None]),
             rng.randrange(1000), float("nan") if rng.random() < 0.3 else rng.random(), None) for _ in range(3000)]
    cols = ["hot", "few", "whole", "nan", "none"]
    df = spark.createDataFrame(rows, "hot double, few double, whole int, nan double, none double").repartition(5)
    got = {r["column"]: r for r in Q.numeric_describe(df, cols).collect()}
    want = pd.DataFrame(rows, columns=cols).astype(float).describe()
    for c in cols:
        for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                             ("p75", "75%"), ("max", "max")):
            a, b = got[c][mine], want[c][theirs]
            assert math.isnan(b) if a is None else a == pytest.approx(b, rel=1e-9), (c, mine)
    assert Q.numeric_describe(df.limit(0), ["hot"]).collect()[0]["count"] == 0


def test_a_value_of_most_rows_is_one_row_a_range(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 != 0, 3.0).otherwise(F.col("id").cast("double")).alias("x"))
    freq = Q.value_frequencies(df, ["x"])
    assert freq.count() == 2001 and freq.filter("v = 3").collect()[0]["n"] == 18_000
    q = Q.exact_quantiles(df, "x", (0.25, 0.95, 1.0)).collect()[0]
    s = df.toPandas()["x"]
    assert (q["q_25"], q["q_95"], q["q_100"]) == (3.0, pytest.approx(s.quantile(0.95)), 19990.0)


def haversine(a, b):
    la, lo, lb, lp = (math.radians(x) for x in (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("radius", [5.0, 400.0])
def test_nearest_distance_equals_brute_force_up_to_the_poles(spark, radius):
    rng = random.Random(3)
    near_pole = [(rng.uniform(88.9, 90.0) * s, rng.uniform(-180, 180)) for s in (1, -1) for _ in range(60)]
    dense = [(45 + rng.gauss(0, 0.01), -110 + rng.gauss(0, 0.01)) for _ in range(500)]
    edge = [(rng.uniform(-1, 1), x) for x in (180.0, -180.0, 179.99, -179.99) for _ in range(20)]
    refs = near_pole[:60] + dense + edge[:40] + [(90.0, 0.0)] + dense[:200]
    cand = near_pole + dense[:50] + [(45 + rng.gauss(0, 0.05), -110 + rng.gauss(0, 0.05)) for _ in range(100)] + edge + [(None, 1.0), (-90.0, 7.0)]
    r = spark.createDataFrame(refs, "decimalLatitude double, decimalLongitude double")
    c = spark.createDataFrame([(i, *p) for i, p in enumerate(cand)], "id long, decimalLatitude double, decimalLongitude double")
    got = {x["id"]: x["nearest_km"] for x in SM.nearest_distance(c, r, "id", radius, leaf=4).collect()}
    kept = {x["id"] for x in SM.exclude_within(c, r, radius).collect()}
    assert len(got) == len(cand)
    for i, p in enumerate(cand):
        d = math.inf if p[0] is None else min(haversine(p, q) for q in refs)
        assert (got[i] is None) == (d >= radius) == (i in kept)
        assert got[i] is None or got[i] == pytest.approx(d, abs=1e-7)
    assert SM.nearest_distance(c, r.limit(0), "id", radius).filter("nearest_km IS NOT NULL").count() == 0


def test_dictionary_join_spreads_a_common_key(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 6, "nowhere").when(F.col("id") % 10 < 8, "town")
                                      .when(F.col("id") % 10 < 9, F.concat(F.lit("site "), F.col("id"))).alias("key"))
    table = spark.createDataFrame([("town", 1.0), ("site 8", 2.0), ("site 18", 3.0), ("unused", 4.0)], "key string, lat double")
    assert {r["key"] for r in D.common_keys(rows, "key").collect()} == {"nowhere", "town"}
    out = D.dictionary_join(rows, table, "key")
    assert out.columns == ["id", "key", "lat"] and out.count() == 20_000
    want = rows.join(table, "key", "left").select("id", "key", "lat")
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    # neither the common keys nor the missing ones are keys of the shuffled join
    plan = out._jdf.queryExecution().toString()
    assert "__own_key" in plan
    keyed = D.dictionary_join(rows, table, "key").withColumn("p", F.spark_partition_id())
    assert keyed.count() == 20_000


def test_geocoding_with_a_sentinel_in_most_rows(spark):
    rows = [(i, None, None, "No specific locality recorded" if i % 10 else f"Site {i}", None, "Town 2" if i % 100 == 0 else None,
             "County 1", "Montana", "US") for i in range(2000)]
    rows += [(5000, 1.0, 2.0, "Site 10", None, None, None, None, None), (5001, None, 3.0, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "ord long, decimalLatitude double, decimalLongitude double, locality string, verbatimLocality string, "
                                     "municipality string, county string, stateProvince string, countryCode string")
    gaz = spark.createDataFrame([("Site 30", 30.0, -30.0), ("town 2", 2.0, -2.0)], "place_key string, lat double, lon double")
    manual = spark.createDataFrame([("locality", "No specific locality recorded", 7.0, -7.0), ("locality", "Site 20", 20.0, -20.0),
                                    ("municipality", "Town 2", 99.0, -99.0)], "kind string, place string, lat double, lon double")
    got = {r["ord"]: (r["decimalLatitude"], r["geocode_pos"]) for r in G.geocode_cascade(df, gaz, manual).collect()}
    assert len(got) == len(rows)
    for i in range(2000):
        want = ((30.0, 3) if i == 30 else (2.0, 8) if i % 100 == 0 else (20.0, 12) if i == 20 else (7.0, 12) if i % 10 else (None, None))
        assert got[i] == want, i
    assert got[5000] == (1.0, None) and got[5001] == (None, None)
    by_map = {r["ord"]: r["decimalLatitude"] for r in G.apply_manual(df, manual).collect()}
    assert by_map[20] == 20.0 and by_map[1] == 7.0 and by_map[100] == 99.0 and by_map[30] is None and by_map[5000] == 1.0
