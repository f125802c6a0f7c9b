"""Composite jobs and the remaining single operators
(B18 feature/target split, D30 arg-min item)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow import sources as SRC
from habiflow.operators import clean as C
from habiflow.operators import geocode as G
from habiflow.operators import jobs as JOBS
from habiflow.operators import model as M
from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.catalog_geo import GEO_SQL, _cands_sql, _soil_sql
from habiflow.plans.catalog_sampling import PRES_SQL, PSEUDO_SELECT, _pseudo_sql
from habiflow.plans.fixtures import with_
from habiflow.plans.registry import query
from habiflow.plans.training import FEATURES, training_set
from habiflow.session import stage_path

OCC = FX.OCC_SQL
VARS = FX.CLIMATE_VARS


@query("prj_feature_select", with_(FX.SCORED_SQL) + """
SELECT probability, prediction, label AS target FROM scored""")
def q_prj_feature_select(spark, sf_dir):
    """feature/target split: numeric columns minus target and excluded
    identifiers (``ord``), target kept as its own column."""
    s = FX.scored(spark, sf_dir)
    feats = M.feature_columns(s, target="label")
    return s.select(*feats, F.col("label").alias("target"))


@query("agg_min_by", with_(FX.RASTER_SQL, S.raster_clean_cte()) + """
SELECT ilat, ilon, arg_min(time, precipitation_amount) AS driest_time,
       round(min(precipitation_amount), 6) AS min_precipitation
FROM rc GROUP BY ilat, ilon""")
def q_agg_min_by(spark, sf_dir):
    """Arg-min item per group (the driest time step of every cell)."""
    spec = FX.raster_spec(spark, sf_dir)
    r = R.clean_raster(FX.cube(spark, sf_dir), spec)
    return r.groupBy("ilat", "ilon").agg(F.min_by("time", "precipitation_amount").alias("driest_time"),
                                        F.round(F.min("precipitation_amount"), 6).alias("min_precipitation"))


def _b12_sql(src: str) -> str:
    return f"""
b12_d AS (SELECT * REPLACE (try(make_timestamp(CAST(year AS BIGINT), CAST(month AS BIGINT), CAST(day AS BIGINT),
                                              0, 0, 0)) AS datetime) FROM {src}),
b12_f AS (SELECT max(CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL THEN 1 ELSE 0 END)
               * max(CASE WHEN datetime IS NOT NULL THEN 1 ELSE 0 END) AS active FROM b12_d),
b12 AS (
  SELECT b12_d.* FROM b12_d, b12_f
  WHERE active = 0 OR decimalLatitude IS NULL OR decimalLongitude IS NULL
     OR coalesce(decimalLatitude BETWEEN 25.067 AND 49.4 AND decimalLongitude BETWEEN -124.8 AND -67.06
        AND datetime BETWEEN TIMESTAMP '1979-01-01' AND TIMESTAMP '2020-12-31', false))"""


_MANUAL_JOIN = """
SELECT c.* REPLACE (
  CASE WHEN c.decimalLatitude IS NULL OR c.decimalLongitude IS NULL THEN coalesce(l.lat, m.lat) ELSE c.decimalLatitude END
    AS decimalLatitude,
  CASE WHEN c.decimalLatitude IS NULL OR c.decimalLongitude IS NULL THEN coalesce(l.lon, m.lon) ELSE c.decimalLongitude END
    AS decimalLongitude)
FROM {src} c
LEFT JOIN (SELECT place, lat, lon FROM manual WHERE kind = 'locality') l ON c.locality = l.place
LEFT JOIN (SELECT place, lat, lon FROM manual WHERE kind = 'municipality') m ON c.municipality = m.place"""


@query("job_geocode", GEO_SQL + "," + _b12_sql("geo") + f""",
l2_m AS ({_MANUAL_JOIN.format(src="b12")})
SELECT ord, gbifID, decimalLatitude, decimalLongitude, datetime, used_llm FROM l2_m
WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL""")
def q_job_geocode(spark, sf_dir):
    """L2: geocode cascade -> grid bounds -> manual fallback -> drop rows
    still without coordinates (T6)."""
    from habiflow.plans.catalog_geo import _geo_input
    g = G.geocode_cascade(_geo_input(spark, sf_dir), FX.gazetteer(spark, sf_dir), FX.manual_geocodes(spark, sf_dir))
    g = C.filter_grid_bounds(g)
    g = G.apply_manual(g, FX.manual_geocodes(spark, sf_dir))
    g = C.drop_any_null(g, ["decimalLatitude", "decimalLongitude"])
    return g.select("ord", "gbifID", "decimalLatitude", "decimalLongitude", "datetime", "used_llm")


_L5_LOC = ("(decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL) OR "
           "coalesce(locality, verbatimLocality, municipality, county, stateProvince) IS NOT NULL")


@query("job_notebook_chain", with_(OCC, FX.RASTER_SQL, FX.GAZETTEER_SQL, FX.MANUAL_SQL, f"""
l5_a AS (SELECT *, NULL::VARCHAR AS landmark FROM occ
         WHERE NOT (continent IS NOT DISTINCT FROM 'ASIA')
           AND NOT coalesce(starts_with(verbatimLocality, 'Canada'), false)
           AND ({_L5_LOC}))""", _cands_sql("l5_a"), f"""
l5_m AS ({_MANUAL_JOIN.format(src="geo")}),
l5_d AS (SELECT *, {S.DATETIME} AS datetime FROM l5_m
         WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL),
l5_e AS (SELECT * FROM l5_d WHERE datetime IS NOT NULL)""", S.nearest_join_ctes("l5_e")) + f"""
SELECT ord, gbifID, gridmet_lat, gridmet_lon, gridmet_date, {", ".join(VARS)} FROM joined""")
def q_job_notebook_chain(spark, sf_dir):
    """Exploration chain: continent/prefix filter -> coords-or-location ->
    geocode cascade + manual map -> drop missing coords -> date cascade ->
    drop missing dates -> nearest-cell raster join."""
    o = C.filter_coords_or_location(C.filter_continent_prefix(FX.occ(spark, sf_dir)))
    g = G.geocode_cascade(o, FX.gazetteer(spark, sf_dir), FX.manual_geocodes(spark, sf_dir))
    g = G.apply_manual(g, FX.manual_geocodes(spark, sf_dir))
    g = C.drop_any_null(g, ["decimalLatitude", "decimalLongitude"])
    g = g.withColumn("datetime", H.multi_source_datetime())
    g = C.drop_any_null(g, ["datetime"])
    spec = FX.raster_spec(spark, sf_dir)
    j = R.nearest_cell_join(g, FX.cube(spark, sf_dir), spec)
    return j.select("ord", "gbifID", "gridmet_lat", "gridmet_lon", "gridmet_date", *VARS)


_U_SQL = f"""
u AS (SELECT 'p' || CAST(gbifID AS VARCHAR) AS row_key, 1 AS occurrence, decimalLatitude, decimalLongitude, geocode_pos, datetime, year,
             month, day, elevation FROM pres
      UNION ALL
      SELECT 'a' || CAST(attempt AS VARCHAR), 0, decimalLatitude, decimalLongitude, NULL, datetime, year, month, day, NULL
      FROM ({PSEUDO_SELECT}))"""


def _table_sql() -> str:
    # the pseudo-absence CTEs, with geocoded presences in place of the cleaned ones
    pseudo = _pseudo_sql()
    head, tail = pseudo.split(PRES_SQL.strip(), 1)
    pres = f"""
tr_in AS (SELECT *, NULL::VARCHAR AS landmark FROM clean),
{_cands_sql("tr_in").strip()},
{_b12_sql("geo").strip()},
tr_m AS ({_MANUAL_JOIN.format(src="b12")}),
pres AS (SELECT * FROM tr_m WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL)"""
    ctes = ",\n".join(x.strip() for x in (FX.RASTER_SQL, FX.GAZETTEER_SQL, FX.MANUAL_SQL, FX.ELEV_SQL, FX.SOIL_SQL))
    la, lo = FX.LAT_AXIS, FX.LON_AXIS
    return (head + ctes + "," + pres + tail.rstrip() + "," + _U_SQL + "," + S.nearest_join_ctes("u") + f""",
t AS (SELECT j.* REPLACE (coalesce(j.elevation, e.elevation) AS elevation), {_soil_sql('s.body')} AS soil_ph
      FROM joined j LEFT JOIN elev e ON e.ilat = {la.sql_index('j.decimalLatitude')} AND e.ilon = {lo.sql_index('j.decimalLongitude')}
      LEFT JOIN soil s ON s.ilat = {la.sql_index('j.decimalLatitude')} AND s.ilon = {lo.sql_index('j.decimalLongitude')})
""")


@query("job_train_table", _table_sql() + """
SELECT row_key, occurrence, geocode_pos, decimalLatitude, decimalLongitude, gridmet_lat, gridmet_lon, gridmet_date, year, month, day,
       elevation, soil_ph, air_temperature, wind_speed
FROM t WHERE elevation IS NOT NULL AND soil_ph IS NOT NULL""")
def q_job_train_table(spark, sf_dir):
    """L3: the table that the train job fits on: cleaned, geocoded, with absences and everything looked up."""
    return training_set(spark, sf_dir).select(
        "row_key", "occurrence", "geocode_pos", "decimalLatitude", "decimalLongitude", "gridmet_lat", "gridmet_lon", "gridmet_date", "year",
        "month", "day", "elevation", "soil_ph", "air_temperature", "wind_speed")


@query("job_train")
def q_job_train(spark, sf_dir):
    """L3: clean -> geocode -> absences -> raster, elevation, soil -> validation
    -> processed and enriched tables written -> forest -> model and importance
    report written -> one run-metadata row."""
    return JOBS.train(spark, training_set(spark, sf_dir), FEATURES, FX.CLIMATE_VARS, stage_path(spark, f"runs/{uuid.uuid4().hex}"))


def _score_points(spark, sf_dir):
    s = FX.scored(spark, sf_dir)
    arr = s.select("ord", F.array("decimalLatitude", "decimalLongitude").alias("coords"))
    pts = SRC.points_from_array(arr, "coords", "ord", strict=True)
    return pts.select("ord", F.col("lat").alias("decimalLatitude"), F.col("lon").alias("decimalLongitude"))


def _score_features(spark, sf_dir):
    return JOBS.score_features(_score_points(spark, sf_dir), FX.cube(spark, sf_dir), FX.raster_spec(spark, sf_dir), FX.elev(spark), FX.soil(spark),
                               FEATURES, "2005-07-01")


@query("job_score_features", with_(FX.SCORED_SQL, FX.RASTER_SQL, FX.ELEV_SQL, FX.SOIL_SQL,
                                   S.nearest_join_ctes("scored", target_date="2005-07-01")) + f"""
SELECT j.ord, j.gridmet_date, CAST(year(j.gridmet_date) AS DOUBLE) AS year, CAST(month(j.gridmet_date) AS DOUBLE) AS month,
       {S.season('month(j.gridmet_date)')} AS season_num, coalesce(e.elevation, 0) AS elevation,
       coalesce({_soil_sql('s.body')}, 0) AS soil_ph, j.air_temperature, j.wind_speed
FROM joined j LEFT JOIN elev e ON e.ilat = {FX.LAT_AXIS.sql_index('j.decimalLatitude')} AND e.ilon = {FX.LON_AXIS.sql_index('j.decimalLongitude')}
LEFT JOIN soil s ON s.ilat = {FX.LAT_AXIS.sql_index('j.decimalLatitude')} AND s.ilon = {FX.LON_AXIS.sql_index('j.decimalLongitude')}""")
def q_job_score_features(spark, sf_dir):
    """L4 up to the model: checked points with climate at the target date, elevation, soil, date parts and season."""
    return _score_features(spark, sf_dir).select("ord", "gridmet_date", "year", "month", "season_num", "elevation", "soil_ph",
                                                 "air_temperature", "wind_speed")


@query("job_score")
def q_job_score(spark, sf_dir):
    """L4: coordinate lists -> points -> validation -> features -> forest ->
    predictions, summary, top predictions, confidence bins, histogram, map
    centre and markers written -> the summary row."""
    t = training_set(spark, sf_dir)
    model = M.random_forest(FEATURES, "occurrence", trees=100, depth=6).fit(t.filter(~F.col("is_test")))
    return JOBS.score(spark, model, _score_features(spark, sf_dir), stage_path(spark, f"runs/{uuid.uuid4().hex}"))
