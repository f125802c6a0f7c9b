"""Grid cells that buffers cover, cells off the sphere, places by own cells: same rows, less to shuffle."""

import math
import random

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators import sampling as SM


def _km(a, b):
    (p, q), (r, s) = ([math.radians(v) for v in x] for x in (a, b))
    h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
    return 2 * H.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def _points(rng, n, la, lo):
    return [(rng.uniform(*la), rng.uniform(*lo)) for _ in range(n)]


def test_covered_cells_take_only_what_the_buffer_excludes(spark):
    rng = random.Random(5)
    boxes = [((45, 45.6), (-100, -99.2)), ((-0.3, 0.3), (179.5, 180)), ((89.5, 90), (-180, 180)), ((-60.2, -60), (-180, -179.5))]
    refs = [p for la, lo in boxes for p in _points(rng, 120, la, lo)]
    cand = [p for la, lo in boxes for p in _points(rng, 500, la, lo)] + [(None, 1.0), (95.0, 0.0), (45.3, None), (float("nan"), 0.0)]
    r = spark.createDataFrame(refs, "decimalLatitude double, decimalLongitude double")
    c = spark.createDataFrame([(i, *p) for i, p in enumerate(cand)], "k int, decimalLatitude double, decimalLongitude double")
    left = {x["k"] for x in SM.drop_covered(c, SM.covered_words(r, 5.0), 5.0).collect()}
    exact = {i for i, p in enumerate(cand) if None in p or math.isnan(p[0]) or p[0] > 90 or min(_km(p, q) for q in refs) >= 5.0}
    assert exact <= left
    assert len(cand) - len(left) > 0.6 * (len(cand) - len(exact))   # most of what the exact test would reject
    kept = {x["k"] for x in SM.exclude_within(c.filter("k < 2000"), r, 5.0).collect()}
    assert kept == {k for k in exact if k < 2000}


def test_dense_presences_send_few_attempts_to_the_exact_test(spark, monkeypatch):
    rng = random.Random(6)
    pres = spark.createDataFrame(_points(rng, 400, (45, 45.5), (-100, -99.5)), "decimalLatitude double, decimalLongitude double"
                                 ).withColumn("datetime", F.lit("2001-02-03").cast("timestamp"))
    seen, exact = [], SM.exclude_within
    monkeypatch.setattr(SM, "exclude_within", lambda c, *a: (seen.append(c.count()), exact(c, *a))[1])
    got = sorted(tuple(r) for r in SM.pseudo_absences(pres).select("attempt", "decimalLatitude", "decimalLongitude").collect())
    assert sum(seen) < 0.1 * 20 * 1200
    monkeypatch.setattr(SM, "covered_words", lambda *a: None)
    seen.clear()
    want = sorted(tuple(r) for r in SM.pseudo_absences(pres).select("attempt", "decimalLatitude", "decimalLongitude").collect())
    assert got == want and sum(seen) == 20 * 1200 and len(seen) == 2


def test_nearest_distance_of_even_hot_and_empty_places(spark, monkeypatch):
    rng = random.Random(7)
    refs = _points(rng, 300, (44, 46), (-101, -99)) + _points(rng, 300, (45, 45.002), (-100, -99.998)) + _points(rng, 40, (-0.4, 0.4), (179.6, 180)) + [(90.0, 0.0)]
    cand = (_points(rng, 300, (44, 47), (-102, -98)) + _points(rng, 60, (45, 45.01), (-100, -99.99)) + _points(rng, 40, (-0.4, 0.4), (-180, -179.7))
            + _points(rng, 20, (89.8, 90), (-180, 180)) + [(10.0, 10.0), (None, 1.0)] + refs[:5] + refs[:2])
    r = spark.createDataFrame(refs + refs[:50], "decimalLatitude double, decimalLongitude double")
    c = spark.createDataFrame([(i, *p) for i, p in enumerate(cand)], "k int, decimalLatitude double, decimalLongitude double")
    rows, cut = [], SM.cut_lineage
    monkeypatch.setattr(SM, "cut_lineage", lambda df, *a: (lambda d: (rows.append(d.count()), d)[1])(cut(df, *a)))
    for leaf in (4, 16):
        rows.clear()
        got = {x["k"]: x["nearest_km"] for x in SM.nearest_distance(c, r, "k", 50.0, leaf=leaf).collect()}
        assert len(got) == len(cand)
        for i, p in enumerate(cand):
            d = math.inf if None in p else min(_km(p, q) for q in refs)
            assert (got[i] is None) if d >= 50.0 else abs(got[i] - d) < 1e-6, (i, p)
        assert max(rows) < 5 * len(cand)   # no step holds many cells a place
    none = SM.nearest_distance(c, r.limit(0), "k", 50.0)
    assert none.count() == len(cand) and none.filter("nearest_km IS NOT NULL").isEmpty()
    assert SM.nearest_distance(c.limit(0), r, "k", 50.0).count() == 0
