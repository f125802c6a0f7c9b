"""Raster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from habiflow import streaming as ST
from habiflow.operators import clean as C
from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import with_
from habiflow.plans.registry import query

VARS = FX.CLIMATE_VARS
OCC = FX.OCC_SQL
RAS = FX.RASTER_SQL
VLIST = ", ".join(VARS)


def r6(c):
    return F.round(c, 6)


def clean_raster(spark, sf_dir):
    spec = FX.raster_spec(spark, sf_dir)
    return R.clean_raster(FX.cube(spark, sf_dir), spec), spec


@query("src_raster_scan", with_(RAS, S.raster_clean_cte()) + f"""
SELECT itime, ilat, ilon, time, lat, lon, {VLIST} FROM rc""")
def q_src_raster_scan(spark, sf_dir):
    """Raster source, all its variables, with NaN normalised to NULL."""
    r, _ = clean_raster(spark, sf_dir)
    return r.select("itime", "ilat", "ilon", "time", "lat", "lon", *VARS)


JOIN_COLS = "gbifID, gridmet_lat, gridmet_lon, gridmet_date, " + VLIST


@query("join_nearest_cell", with_(OCC, RAS, S.clean_ctes(), S.nearest_join_ctes("clean")) + f"""
SELECT {JOIN_COLS} FROM joined""")
def q_join_nearest_cell(spark, sf_dir):
    """Cleaned occurrences snapped to their nearest (time, lat, lon) cell."""
    spec = FX.raster_spec(spark, sf_dir)
    occ = C.clean_occurrences(FX.occ(spark, sf_dir))
    j = R.nearest_cell_join(occ, FX.cube(spark, sf_dir), spec, days=ST.DAYS)
    return j.select("gbifID", "gridmet_lat", "gridmet_lon", "gridmet_date", *VARS)


@query("join_target_date", with_(OCC, RAS, S.clean_ctes(time_filter=False),
                                 S.nearest_join_ctes("clean", target_date="1978-06-01")) + f"""
SELECT {JOIN_COLS} FROM joined""")
def q_join_target_date(spark, sf_dir):
    """A fixed target date outside the raster range clamps to the last date."""
    spec = FX.raster_spec(spark, sf_dir)
    occ = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    j = R.nearest_cell_join(occ, FX.cube(spark, sf_dir), spec, target_date="1978-06-01")
    return j.select("gbifID", "gridmet_lat", "gridmet_lon", "gridmet_date", *VARS)


@query("join_points_at_date", with_(OCC, RAS, """
pts AS (SELECT ord, decimalLatitude, decimalLongitude FROM occ WHERE decimalLatitude IS NOT NULL)""",
                                    S.nearest_join_ctes("pts", datetime_col=None)) + f"""
SELECT ord, gridmet_lat, gridmet_lon, gridmet_date, {VLIST} FROM joined""")
def q_join_points_at_date(spark, sf_dir):
    """C11: points without a date column are read at the latest raster date
    (vectorised point selection at one date)."""
    spec = FX.raster_spec(spark, sf_dir)
    pts = FX.occ(spark, sf_dir).filter(F.col("decimalLatitude").isNotNull()).select(
        "ord", "decimalLatitude", "decimalLongitude")
    j = R.nearest_cell_join(pts, FX.cube(spark, sf_dir), spec, datetime_col=None)
    return j.select("ord", "gridmet_lat", "gridmet_lon", "gridmet_date", *VARS)


@query("join_conditional_enrich", with_(OCC, RAS, S.clean_ctes(time_filter=False), """
lab AS (SELECT *, CASE WHEN gbifID % 4 = 0 THEN 1 ELSE 0 END AS presence FROM clean
        WHERE decimalLatitude IS NOT NULL)""",
                                        S.nearest_join_ctes("lab")) + """
SELECT gbifID, presence, NULL::DOUBLE AS air_temperature FROM lab WHERE presence = 1
UNION ALL
SELECT gbifID, presence, air_temperature FROM joined WHERE presence = 0""")
def q_join_conditional_enrich(spark, sf_dir):
    """Rows already enriched (presences) pass; the others are joined,
    failures dropped; the two branches are unioned."""
    spec = FX.raster_spec(spark, sf_dir)
    occ = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    lab = occ.filter(F.col("decimalLatitude").isNotNull()).withColumn(
        "presence", F.when(F.col("gbifID") % 4 == 0, 1).otherwise(0))
    keep = lab.filter("presence = 1").select("gbifID", "presence",
                                             F.lit(None).cast("double").alias("air_temperature"))
    todo = lab.filter("presence = 0")
    j = R.nearest_cell_join(todo, FX.cube(spark, sf_dir), spec)
    return keep.unionByName(j.select("gbifID", "presence", "air_temperature"))


@query("raster_sel_nearest", with_(RAS, S.raster_clean_cte()) + f"""
SELECT itime, time, lat, lon, air_temperature FROM rc
WHERE ilat = {FX.LAT_AXIS.sql_index('45.3')} AND ilon = {FX.LON_AXIS.sql_index('-111.2')}""")
def q_raster_sel_nearest(spark, sf_dir):
    """Nearest label selection on lat/lon -> the time series of one cell."""
    r, spec = clean_raster(spark, sf_dir)
    return R.select_nearest(r, spec, lat=45.3, lon=-111.2).select(
        "itime", "time", "lat", "lon", "air_temperature")


@query("join_broadcast_axes", with_(RAS) + """
SELECT a.ilat, a.lat, b.ilon, b.lon FROM (SELECT DISTINCT ilat, lat FROM raster) a,
       (SELECT DISTINCT ilon, lon FROM raster) b""")
def q_join_broadcast_axes(spark, sf_dir):
    """Cartesian product of the two spatial axes read off the raster."""
    r = FX.cube(spark, sf_dir)
    return R.broadcast_axes(r.select("ilat", "lat").distinct(), r.select("ilon", "lon").distinct())


@query("join_align_inner", with_(RAS, "ra AS MATERIALIZED (SELECT itime, ilat, ilon, air_temperature FROM raster)") + """
SELECT a.itime, a.ilat, a.ilon, a.air_temperature - b.air_temperature AS delta
FROM ra a JOIN ra b ON b.itime = a.itime + 1 AND b.ilat = a.ilat AND b.ilon = a.ilon""")
def q_join_align_inner(spark, sf_dir):
    """Inner alignment on exact coordinates of a cube and its one-step
    time shift (arithmetic between aligned cubes)."""
    spec = FX.raster_spec(spark, sf_dir)
    a, b = (R.clean_raster(FX.cube_by_block(spark, sf_dir, shift), spec) for shift in (0, 1))
    a = a.select("block", "itime", "ilat", "ilon", "air_temperature")
    b = b.select("block", (F.col("itime") - 1).alias("itime"), "ilat", "ilon",
                 F.col("air_temperature").alias("b_air"))
    j = R.align_inner(a, b, ["itime", "ilat", "ilon"], block="block")
    return j.select("itime", "ilat", "ilon", (F.col("air_temperature") - F.col("b_air")).alias("delta"))


@query("join_align_exact_check", with_(RAS) + """
SELECT side, count(*) AS n FROM (
  SELECT 'left' AS side FROM (SELECT itime, ilat, ilon FROM raster
                             EXCEPT SELECT itime - 1, ilat, ilon FROM raster)
  UNION ALL
  SELECT 'right' FROM (SELECT itime - 1, ilat, ilon FROM raster
                       EXCEPT SELECT itime, ilat, ilon FROM raster)) GROUP BY side""")
def q_join_align_exact_check(spark, sf_dir):
    """C10 join='exact': coordinates without a partner on either side (empty
    means the cubes align exactly)."""
    r = FX.cube(spark, sf_dir).select("itime", "ilat", "ilon")
    b = r.select((F.col("itime") - 1).alias("itime"), "ilat", "ilon")
    return R.alignment_mismatch(r, b, ["itime", "ilat", "ilon"]).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"))


@query("flt_dynamic_bounds", with_(OCC, RAS, """
b AS (SELECT min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM raster)""") + """
SELECT ord, decimalLatitude, decimalLongitude FROM occ, b
WHERE decimalLatitude BETWEEN lat_min AND lat_max AND decimalLongitude BETWEEN lon_min AND lon_max""")
def q_flt_dynamic_bounds(spark, sf_dir):
    """Bounds read from the raster axes (one-row aggregate), then a filter."""
    r = FX.cube(spark, sf_dir)
    b = r.agg(F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
              F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))
    pts = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude")
    return R.extent_filter(pts, b)


@query("raster_slice", with_(RAS, S.raster_clean_cte()) + """
SELECT itime, ilat, ilon, time, air_temperature FROM rc
WHERE strftime(time, '%Y-%m') = '1979-05' AND ilat >= 2 AND ilat < 6""")
def q_raster_slice(spark, sf_dir):
    """Partial-date label slice (a month) and a position slice (isel)."""
    r, spec = clean_raster(spark, sf_dir)
    s = R.slice_index(R.slice_time(r, month="1979-05", spec=spec), ilat=(2, 6))
    return s.select("itime", "ilat", "ilon", "time", "air_temperature")


@query("raster_slice_range", with_(RAS, S.raster_clean_cte()) + """
SELECT itime, ilat, ilon, time, precipitation_amount FROM rc
WHERE time BETWEEN DATE '1979-03-01' AND DATE '1979-06-30' AND lat BETWEEN 40 AND 46""")
def q_raster_slice_range(spark, sf_dir):
    """Inclusive label slices on time and latitude."""
    r, spec = clean_raster(spark, sf_dir)
    s = R.slice_time(r, start="1979-03-01", end="1979-06-30", spec=spec).filter(F.col("lat").between(40, 46))
    return s.select("itime", "ilat", "ilon", "time", "precipitation_amount")


@query("raster_pivot", with_(RAS, S.raster_clean_cte()) + "SELECT itime, ilat, " + ", ".join(
    f"max(CASE WHEN ilon = {k} THEN air_temperature END) AS lon_{k}" for k in range(FX.LON_AXIS.size))
       + " FROM rc GROUP BY itime, ilat")
def q_raster_pivot(spark, sf_dir):
    """Long cube -> wide table (one column per longitude index)."""
    r, spec = clean_raster(spark, sf_dir)
    w = R.to_wide(r, "air_temperature", list(range(spec.lon.size)))
    return w.select("itime", "ilat", *[F.col(str(k)).alias(f"lon_{k}") for k in range(spec.lon.size)])


@query("raster_from_wide", with_(RAS, S.raster_clean_cte()) + """
SELECT itime, ilat, ilon, air_temperature FROM rc""")
def q_raster_from_wide(spark, sf_dir):
    """The wide table read back into a cube (the round trip gives every cell)."""
    r, spec = clean_raster(spark, sf_dir)
    w = R.to_wide(r, "air_temperature", list(range(spec.lon.size)))
    return R.from_wide(w, "air_temperature").select("itime", "ilat", "ilon", "air_temperature")


@query("agg_cube_density", with_(OCC, S.clean_ctes(), RAS, f"""
p AS (SELECT {FX.LAT_AXIS.sql_index('decimalLatitude')} AS ilat, {FX.LON_AXIS.sql_index('decimalLongitude')} AS ilon FROM clean
      WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL),
c AS (SELECT 'raster' AS source, itime AS t, ilat, ilon FROM raster UNION ALL SELECT 'occurrences', 0, ilat, ilon FROM p),
k AS (SELECT source, t, ilat, ilon, count(*) AS n FROM c GROUP BY ALL)""") + """
SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, count(DISTINCT t) * count(DISTINCT ilat) * count(DISTINCT ilon) AS n_cells,
       count(*) FILTER (n > 1) AS n_repeated,
       sum(n) = count(DISTINCT t) * count(DISTINCT ilat) * count(DISTINCT ilon) AND count(*) FILTER (n > 1) = 0 AS dense
FROM k GROUP BY source""")
def q_agg_cube_density(spark, sf_dir):
    """Whether a table is a whole cube: the raster is, the occurrences' cells are not."""
    spec = FX.raster_spec(spark, sf_dir)
    o = C.clean_occurrences(FX.occ(spark, sf_dir)).filter("decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL")
    cells = R.snap_cells(o, spec).withColumn("t", F.lit(0))
    a = R.density(FX.cube(spark, sf_dir), ["itime", "ilat", "ilon"]).withColumn("source", F.lit("raster"))
    return a.unionByName(R.density(cells, ["t", "ilat", "ilon"]).withColumn("source", F.lit("occurrences")))


@query("raster_sel_many", """
WITH a AS (SELECT CAST(c_acctbal AS DOUBLE) AS v, min(c_custkey) AS i FROM customer GROUP BY 1),
l AS (SELECT DISTINCT CAST(o_totalprice AS DOUBLE) / 40 - 1000 AS label FROM orders),
n AS (SELECT l.label, d.v AS dv, d.i AS di, u.v AS uv, u.i AS ui
      FROM l ASOF LEFT JOIN a d ON l.label >= d.v ASOF LEFT JOIN a u ON l.label <= u.v)
SELECT label,
  CASE WHEN uv IS NULL OR label - dv < uv - label OR (label - dv = uv - label AND di < ui) THEN di ELSE ui END AS i,
  CASE WHEN uv IS NULL OR label - dv < uv - label OR (label - dv = uv - label AND di < ui) THEN dv ELSE uv END AS v
FROM n""")
def q_raster_sel_many(spark, sf_dir):
    """Many labels on an unevenly spaced axis (the account balances)."""
    axis = FX.read(spark, sf_dir, "customer").select(F.col("c_acctbal").cast("double").alias("v"), F.col("c_custkey").alias("i"))
    labels = FX.read(spark, sf_dir, "orders").select((F.col("o_totalprice").cast("double") / 40 - 1000).alias("label"))
    return R.nearest_on_axis(labels, "label", axis, "v", "i").select("label", "i", "v")


@query("raster_seasonal_mean", with_(RAS, S.raster_clean_cte()) + f"""
SELECT CASE {S.season('month(time)')} WHEN 0 THEN 'DJF' WHEN 1 THEN 'MAM' WHEN 2 THEN 'JJA' WHEN 3 THEN 'SON' END
         AS season,
       {S.season('month(time)')} AS season_order,
       """ + ", ".join(f"round(avg({v}), 6) AS {v}" for v in VARS) + """
FROM rc GROUP BY 1, 2""")
def q_raster_seasonal_mean(spark, sf_dir):
    """D25 + F6: mean per season in DJF/MAM/JJA/SON order."""
    r, spec = clean_raster(spark, sf_dir)
    s = R.seasonal_mean(r, list(VARS))
    return s.select("season", "season_order", *[r6(F.col(v)).alias(v) for v in VARS])


@query("raster_monthly_mean", with_(RAS, S.raster_clean_cte()) + """
SELECT last_day(time) AS month_end, ilat, ilon, round(avg(air_temperature), 6) AS air_temperature,
       round(avg(precipitation_amount), 6) AS precipitation_amount
FROM rc GROUP BY 1, 2, 3""")
def q_raster_monthly_mean(spark, sf_dir):
    """Resample to month ends, mean per cell."""
    r, _ = clean_raster(spark, sf_dir)
    m = R.monthly_mean(r, ["air_temperature", "precipitation_amount"])
    return m.select("month_end", "ilat", "ilon", r6(F.col("air_temperature")).alias("air_temperature"),
                    r6(F.col("precipitation_amount")).alias("precipitation_amount"))


@query("raster_weighted_mean", with_(RAS, S.raster_clean_cte()) + """
SELECT itime, round(sum(air_temperature * w) / sum(CASE WHEN air_temperature IS NOT NULL THEN w END), 6)
         AS air_temperature_wmean
FROM (SELECT *, abs((6371000.0 * radians(2.0)) * (6371000.0 * radians(2.0) * cos(radians(lat)))) AS w FROM rc)
GROUP BY itime""")
def q_raster_weighted_mean(spark, sf_dir):
    """Area-weighted spatial mean per time step."""
    r, spec = clean_raster(spark, sf_dir)
    w = R.weighted_mean(r, "air_temperature", spec, by=["itime"])
    return w.select("itime", r6(F.col("air_temperature_wmean")).alias("air_temperature_wmean"))


@query("raster_dim_mean", with_(RAS, S.raster_clean_cte()) + """
SELECT ilat, ilon, round(avg(air_temperature), 6) AS air_temperature, round(avg(wind_speed), 6) AS wind_speed
FROM rc GROUP BY ilat, ilon""")
def q_raster_dim_mean(spark, sf_dir):
    """Mean over the time dimension."""
    r, _ = clean_raster(spark, sf_dir)
    d = R.dim_mean(r, ["air_temperature", "wind_speed"], keep=["ilat", "ilon"])
    return d.select("ilat", "ilon", r6(F.col("air_temperature")).alias("air_temperature"),
                    r6(F.col("wind_speed")).alias("wind_speed"))


@query("raster_coarsen", with_(RAS, S.raster_clean_cte()) + """
SELECT itime, CAST(floor(ilat / 3) AS INTEGER) AS blat, CAST(floor(ilon / 3) AS INTEGER) AS blon,
       round(avg(air_temperature), 6) AS air_temperature
FROM rc GROUP BY 1, 2, 3""")
def q_raster_coarsen(spark, sf_dir):
    """3 x 3 block mean."""
    r, _ = clean_raster(spark, sf_dir)
    c = R.coarsen(r, ["air_temperature"], 3, 3)
    return c.select("itime", "blat", "blon", r6(F.col("air_temperature")).alias("air_temperature"))


ANNUAL_SQL = """
annual AS (
  SELECT ilat, ilon, CAST(year(time) AS INTEGER) AS year, avg(air_temperature) AS mean_air_temperature,
         sum(precipitation_amount) AS total_precipitation,
         avg(surface_downwelling_shortwave_flux_in_air) AS mean_srad,
         avg(mean_vapor_pressure_deficit) AS mean_vpd
  FROM rc GROUP BY 1, 2, 3
)"""


@query("raster_annual_features", with_(RAS, S.raster_clean_cte(), ANNUAL_SQL) + """
SELECT ilat, ilon, year, round(mean_air_temperature, 6) AS mean_air_temperature,
       round(total_precipitation, 6) AS total_precipitation, round(mean_srad, 6) AS mean_srad,
       round(mean_vpd, 6) AS mean_vpd FROM annual""")
def q_raster_annual_features(spark, sf_dir):
    """D31 [plan]: per cell and year, mean temperature, total precipitation,
    mean radiation and mean VPD."""
    r, _ = clean_raster(spark, sf_dir)
    a = R.annual_features(r)
    return a.select("ilat", "ilon", "year", *[r6(F.col(c)).alias(c) for c in
                                             ("mean_air_temperature", "total_precipitation",
                                              "mean_srad", "mean_vpd")])


@query("raster_rolling_mean", with_(RAS, S.raster_clean_cte(), ANNUAL_SQL) + """
SELECT ilat, ilon, year,
       round(avg(total_precipitation) OVER (PARTITION BY ilat, ilon ORDER BY year
                                            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
         AS total_precipitation_rolling
FROM annual""")
def q_raster_rolling_mean(spark, sf_dir):
    """E7 [plan]: trailing 3-year mean of annual precipitation per cell."""
    r, _ = clean_raster(spark, sf_dir)
    a = R.rolling_mean(R.annual_features(r), "total_precipitation", 3)
    return a.select("ilat", "ilon", "year",
                    r6(F.col("total_precipitation_rolling")).alias("total_precipitation_rolling"))


@query("agg_extent", with_(OCC, RAS, S.clean_ctes()) + """
SELECT 'occurrences' AS source, min(decimalLatitude) AS lat_min, max(decimalLatitude) AS lat_max,
       min(decimalLongitude) AS lon_min, max(decimalLongitude) AS lon_max,
       CAST(min(datetime) AS DATE) AS time_min, CAST(max(datetime) AS DATE) AS time_max,
       count(DISTINCT decimalLatitude) AS n_lat, count(DISTINCT decimalLongitude) AS n_lon,
       count(DISTINCT CAST(datetime AS DATE)) AS n_time FROM clean
UNION ALL
SELECT 'raster', min(lat), max(lat), min(lon), max(lon), min(time), max(time),
       count(DISTINCT lat), count(DISTINCT lon), count(DISTINCT time) FROM raster""")
def q_agg_extent(spark, sf_dir):
    """Extent of the cleaned points and of the raster axes."""
    occ = C.clean_occurrences(FX.occ(spark, sf_dir))
    o = occ.select(F.col("decimalLatitude").alias("lat"), F.col("decimalLongitude").alias("lon"),
                   F.to_date("datetime").alias("time"))
    a = R.raster_extent(o).withColumn("source", F.lit("occurrences"))
    b = R.axes_extent(FX.cube(spark, sf_dir)).withColumn("source", F.lit("raster"))
    return a.unionByName(b)


@query("srt_latest_slice", with_(RAS, S.raster_clean_cte()) + """
SELECT ilat, ilon, time, air_temperature FROM rc WHERE time = (SELECT max(time) FROM rc)""")
def q_srt_latest_slice(spark, sf_dir):
    """the latest time slice (the last partition, then the last time in it)."""
    r, _ = clean_raster(spark, sf_dir)
    return R.latest_slice(r).select("ilat", "ilon", "time", "air_temperature")
