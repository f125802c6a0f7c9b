"""Operator properties on the smallest driver tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from habiflow import sources as SRC
from habiflow.operators import clean as C
from habiflow.operators import quality as Q
from habiflow.operators import raster as R
from habiflow.operators import sampling as SM
from habiflow.plans import fixtures as FX


def test_required_column_gate(spark):
    df = spark.createDataFrame([(1, 2.0)], "gbifID long, decimalLatitude double")
    with pytest.raises(ValueError, match="eventDate"):
        C.require_columns(df)


def test_tsv_reader_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="habiflow-test-")
    p = os.path.join(d, "occ.txt")
    with open(p, "w") as f:
        f.write("gbifID\tdecimalLatitude\tdecimalLongitude\teventDate\tcountryCode\tcounty\textra\n")
        f.write("1\t45.5\t-111.2\t1946-06-28\tUS\tGallatin\tx\n")
        f.write("2\tn/a\t\t\tUS\t\ty\n")
    df = SRC.read_occurrences(spark, p)
    rows = df.orderBy("gbifID").collect()
    assert rows[0]["decimalLatitude"] == 45.5 and rows[1]["decimalLatitude"] is None
    with pytest.raises(ValueError):
        bad = os.path.join(d, "bad.txt")
        with open(bad, "w") as f:
            f.write("gbifID\tdecimalLatitude\n1\t2\n")
        SRC.read_occurrences(spark, bad)
    out = os.path.join(d, "stage")
    SRC.write_table(df.drop("ord"), out)
    assert SRC.read_table(spark, out).count() == 2


def test_dedup_keep_first(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 2, "a"), (None, 9, "n1"), (None, 3, "n2"), (2, 1, "z")],
                               "gbifID long, ord long, v string")
    got = {(r["gbifID"], r["v"]) for r in C.dedup_keep_first(df).collect()}
    assert got == {(1, "a"), (None, "n2"), (2, "z")}


def test_bounds_keep_missing(spark):
    df = spark.createDataFrame([(45.0, -110.0), (None, -110.0), (80.0, -110.0), (45.0, None)],
                               "decimalLatitude double, decimalLongitude double")
    assert C.filter_bounds_keep_missing(df).count() == 3


def test_buffer_exclusion_equals_brute_force(spark, sf_small):
    """Bucket join == brute-force haversine on the small fixture."""
    from habiflow import functions as H
    pres = C.clean_occurrences(FX.occ(spark, sf_small)).filter(F.col("decimalLatitude").isNotNull())
    cand = FX.occ(spark, sf_small).filter(F.col("decimalLatitude").isNotNull()).select(
        "ord", "decimalLatitude", "decimalLongitude")
    for km in (5.0, 300.0):
        fast = {r["ord"] for r in SM.exclude_within(cand, pres, km).collect()}
        p = pres.select(F.col("decimalLatitude").alias("pl"), F.col("decimalLongitude").alias("po"))
        near = cand.crossJoin(p).filter(H.haversine_km("decimalLatitude", "decimalLongitude", "pl", "po") < km)
        brute = {r["ord"] for r in cand.join(near.select("ord").distinct(), "ord", "left_anti").collect()}
        assert fast == brute


def test_pseudo_absences_respect_buffer(spark, sf_small):
    """K2: no accepted point closer than 5 km to a presence; size = 3n or fewer."""
    from habiflow import functions as H
    pres = C.clean_occurrences(FX.occ(spark, sf_small)).filter(F.col("decimalLatitude").isNotNull())
    n = pres.count()
    a = SM.pseudo_absences(pres)
    assert a.count() <= int(n * 3.0)
    p = pres.select(F.col("decimalLatitude").alias("pl"), F.col("decimalLongitude").alias("po"))
    close = a.crossJoin(p).filter(H.haversine_km("decimalLatitude", "decimalLongitude", "pl", "po") < 5.0)
    assert close.count() == 0
    labels = {r[0] for r in SM.label_and_union(pres.select("decimalLatitude", "decimalLongitude", "month"),
                                                a.drop("occurrence")).select("occurrence").distinct().collect()}
    assert labels == {0, 1}   # T1 regression: both classes survive


def test_split_sizes_golden(spark):
    for n, test in ((16, 4), (15, 3)):
        df = spark.range(n).withColumnRenamed("id", "k")
        s = SM.train_test_split(df, "k", 0.2)
        assert s.filter("is_test").count() == test and s.filter("not is_test").count() == n - test


def test_folds_balanced(spark, sf_small):
    lab = FX.read(spark, sf_small, "labels")
    f = SM.stratified_folds(lab, "quality", "doc_id")
    counts = {(r["quality"], r["fold"]): r["count"] for r in f.groupBy("quality", "fold").count().collect()}
    for q in (0, 1):
        vals = [counts.get((q, k), 0) for k in range(5)]
        assert max(vals) - min(vals) <= 1


def test_fingerprint_partition_invariant(spark, sf_small):
    o = FX.occ(spark, sf_small).select("gbifID", "countryCode", "locality")
    a = Q.fingerprint(o).collect()[0]
    b = Q.fingerprint(o.repartition(7).orderBy(F.rand(1))).collect()[0]
    assert a == b


def test_exact_quantiles_match_pandas(spark, sf_small):
    o = FX.occ(spark, sf_small).select("decimalLatitude")
    q = Q.exact_quantiles(o, "decimalLatitude", (0.25, 0.5, 0.75)).collect()[0]
    s = o.toPandas()["decimalLatitude"].dropna()
    for p, c in ((0.25, "q_25"), (0.5, "q_50"), (0.75, "q_75")):
        assert abs(q[c] - s.quantile(p)) < 1e-9


def test_bbox_grid_golden(spark):
    # Idaho box at 0.05 degrees: 141 x 124 = 17,484 points (numpy arange sizes)
    g = SRC.bbox_grid(spark, 41.99, 49.00, -117.24, -111.04, 0.05)
    assert g.count() == 141 * 124


def test_points_from_array_and_odd(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [5.0, 6.0, 7.0])], "k long, a array<double>")
    assert SRC.points_from_array(df, "a", "k", strict=False).count() == 3
    assert [r["k"] for r in SRC.odd_length_rows(df, "a").collect()] == [2]


def test_identical(spark):
    a = spark.range(5)
    assert SRC.identical(a, spark.range(5)).collect()[0][0] is True
    assert SRC.identical(a, spark.range(6)).collect()[0][0] is False


def test_model_save_load(spark, sf_small):
    from pyspark.ml import PipelineModel
    from habiflow.operators import model as M
    from habiflow.plans.training import FEATURES, training_set
    t = training_set(spark, sf_small)
    m = M.random_forest(FEATURES, trees=5, depth=3).fit(t)
    d = os.path.join(tempfile.mkdtemp(prefix="habiflow-model-"), "m")
    m.write().overwrite().save(d)
    m2 = PipelineModel.load(d)
    a = M.score(m, t, ["row_key"]).orderBy("row_key").collect()
    b = M.score(m2, t, ["row_key"]).orderBy("row_key").collect()
    assert a == b


def test_stream_equals_batch(spark, sf_small):
    """The streamed enrichment equals the batch pipeline (without dedup)."""
    import __spark_entry__ as E
    s = E.queries()["stream_enrich"](spark, sf_small)
    from habiflow.operators import raster as R
    from habiflow.streaming import clean_stateless
    spec = FX.raster_spec(spark, sf_small)
    b = R.nearest_cell_join(clean_stateless(FX.occ(spark, sf_small)), FX.raster(spark, sf_small), spec)
    cols = ["ord", "gridmet_lat", "gridmet_lon", "gridmet_date", "air_temperature"]
    assert sorted(s.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_prediction_sinks(spark, sf_small):
    """A5: threshold-filtered predictions and a JSON summary, written by Spark."""
    from habiflow.operators import reports as RP
    s = FX.scored(spark, sf_small)
    d = tempfile.mkdtemp(prefix="habiflow-sink-")
    SRC.write_above_threshold(s, os.path.join(d, "top"), 0.8)
    back = spark.read.option("header", True).csv(os.path.join(d, "top"))
    assert back.count() == s.filter("probability >= 0.8").count()
    SRC.write_json_summary(RP.scoring_summary(s, 0.8), os.path.join(d, "summary"))
    j = spark.read.json(os.path.join(d, "summary")).collect()[0]
    assert j["total_coordinates"] == s.count() and len(j["top_locations"]) == 5


def test_feature_gate(spark):
    """Scoring refuses frames missing model features."""
    from habiflow.operators import model as M
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="b"):
        M.require_features(df, ["a", "b"])


def test_buffer_across_the_date_line(spark):
    cand = spark.createDataFrame([(1, 10.0, 179.995), (2, 10.0, 179.5), (3, 10.0, -179.995)], "id int, decimalLatitude double, decimalLongitude double")
    ref = spark.createDataFrame([(10.0, -179.992)], "decimalLatitude double, decimalLongitude double")
    assert {r["id"] for r in SM.exclude_within(cand, ref, 5.0).collect()} == {2}
    near = {r["id"]: r["nearest_km"] for r in SM.nearest_distance(cand, ref, "id", 5.0).collect()}
    assert near[2] is None and near[1] < 2 and near[3] < 1


def test_text_nan_is_a_missing_coordinate(spark):
    from habiflow.operators import clean as CL
    df = spark.createDataFrame([("NaN", "NaN"), ("45", "-110"), ("x", "1")], "decimalLatitude string, decimalLongitude string")
    got = [tuple(r) for r in CL.filter_bounds_keep_missing(CL.coerce_numeric(df)).collect()]
    assert got == [(None, None), (45.0, -110.0), (None, 1.0)]


def test_excluded_names_are_no_features(spark):
    from habiflow.operators import model as MO
    df = spark.createDataFrame([(1, 2.0, 3.0, 4, 5, 1, 2000.0, 7.0)], "gbifID int, decimalLatitude double, decimalLongitude double, "
                               "month int, day int, occurrence int, year double, elevation double")
    assert MO.feature_columns(df) == ["year", "elevation"]


def test_test_split_is_scaled_by_the_train_split(spark):
    from habiflow.operators import model as MO
    train = spark.createDataFrame([(0.0,), (2.0,)], "f double")
    test = spark.createDataFrame([(3.0,)], "f double")
    assert MO.standardize(test, ["f"], fit_on=train).first()["f"] == 2.0


def test_append_resumable_appends_what_is_pending(spark, tmp_path):
    from habiflow import sources as SO
    out = str(tmp_path / "out")
    enrich = lambda d: d.withColumn("v", d["id"] * 2)
    assert SO.append_resumable(spark.range(5), out, ["id"], enrich) == 5
    assert SO.append_resumable(spark.range(8), out, ["id"], enrich) == 3
    assert spark.read.parquet(out).count() == 8


def test_odd_coordinate_list_is_an_error(spark):
    import pytest
    from habiflow import sources as SO
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, a array<double>")
    with pytest.raises(Exception, match="odd length"):
        SO.points_from_array(df, "a", "k").collect()


def test_raster_blocks_of_another_size_and_pruning(spark, sf_small):
    from dataclasses import replace
    spec = FX.raster_spec(spark, sf_small)
    cube = FX.raster(spark, sf_small)
    pts = cube.filter("itime in (3, 60)").select("lat", "lon", cube["time"].cast("timestamp").alias("datetime"))
    pts = pts.withColumnRenamed("lat", "decimalLatitude").withColumnRenamed("lon", "decimalLongitude")
    a = R.nearest_cell_join(pts, cube, spec)
    other = cube.withColumn("tblock", (cube["itime"] / 20).cast("int"))
    b = R.nearest_cell_join(pts, other, replace(spec, time_block=20))
    assert a.count() == b.count() > 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert any("tblock" in p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:])
