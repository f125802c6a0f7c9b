"""The raster source gives its whole table: every time step, every cell, all eight variables."""

import math

from habiflow.plans import fixtures as FX


def test_the_scan_reads_all_variables(spark, tmp_path):
    import __spark_entry__ as E
    spark.createDataFrame([(k,) for k in range(3)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = E.queries()["src_raster_scan"](spark, str(tmp_path))
    assert got.columns == ["itime", "ilat", "ilon", "time", "lat", "lon", *FX.CLIMATE_VARS]
    rows = {(r["itime"], r["ilat"], r["ilon"]): r for r in got.collect()}
    want = FX.cube(spark, str(tmp_path)).collect()
    assert len(rows) == len(want) == 3 * FX.LAT_AXIS.size * FX.LON_AXIS.size
    for w in want:
        r = rows[w["itime"], w["ilat"], w["ilon"]]
        for v in FX.CLIMATE_VARS:
            assert r[v] == (None if w[v] is None or math.isnan(w[v]) else w[v])
