"""Queries for sources, filters, projections, scalar functions and the
flagship (SURVEY §2.1, §2.2, §2.8, E1, L1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators import clean as C
from habiflow.operators import raster as R
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import U, with_
from habiflow.plans.registry import query
from habiflow.sources import CORRUPT, read_dump, write_dump
from habiflow import streaming as ST

VARS = FX.CLIMATE_VARS
OCC = FX.OCC_SQL


def r6(c):
    return F.round(c, 6)


def avg_vars_spark():
    return [r6(F.avg(v)).alias(f"avg_{v}") for v in VARS]


def avg_vars_sql(prefix: str = "") -> str:
    return ", ".join(f"round(avg({prefix}{v}), 6) AS avg_{v}" for v in VARS)


# ----------------------------------------------------------- flagship ----

def flagship(spark, sf_dir):
    """Cleaned occurrences joined to their nearest raster cell, mean of the
    eight climate variables per season (SURVEY §7 step 1)."""
    spec = FX.raster_spec(spark, sf_dir)
    occ = C.clean_occurrences(FX.occ(spark, sf_dir))
    j = R.nearest_cell_join(occ, FX.cube(spark, sf_dir), spec, days=ST.DAYS)
    return (j.groupBy("season_num")
             .agg(F.count(F.lit(1)).alias("n"), *avg_vars_spark()))


FLAGSHIP_SQL = with_(OCC, FX.RASTER_SQL, S.clean_ctes(), S.nearest_join_ctes("clean")) + f"""
SELECT season_num, count(*) AS n, {avg_vars_sql()} FROM joined GROUP BY season_num"""

query("flagship_seasonal_climate", FLAGSHIP_SQL)(flagship)


# ------------------------------------------------------------ sources ----

_DUMP_COLS = ("ord", "gbifID", "decimalLatitude", "decimalLongitude", "eventDate", "year", "countryCode", "county", "locality")


def _dump(spark, sf_dir):
    """The occurrences as a tab-separated dump of several files; some lines are cut short or have a field too many."""
    path = ST.scratch_folders(spark, "dump")[0]
    o = FX.occ(spark, sf_dir)
    lat = F.when(F.col("gbifID") % 13 == 0, "n/a").otherwise(F.col("decimalLatitude").cast("string"))
    text = [F.coalesce(lat if c == "decimalLatitude" else F.col(c).cast("string"), F.lit("")) for c in _DUMP_COLS]
    line = (F.when(F.col("gbifID") % 29 == 0, F.concat_ws("\t", *text[:4])).when(F.col("gbifID") % 31 == 0, F.concat_ws("\t", *text, F.lit("x")))
            .otherwise(F.concat_ws("\t", *text)))
    write_dump(o.select(line.alias("value")), _DUMP_COLS, path)
    return path


@query("src_dump_read", with_(OCC) + """
SELECT ord, gbifID, CASE WHEN gbifID % 13 <> 0 THEN decimalLatitude END AS decimalLatitude, decimalLongitude,
       eventDate, year, countryCode, county, locality
FROM occ WHERE gbifID % 29 <> 0 AND gbifID % 31 <> 0""")
def q_src_dump_read(spark, sf_dir):
    """A1/A2: a dump read through its header, without its malformed lines."""
    good, _ = read_dump(spark, _dump(spark, sf_dir))
    return good.withColumn("ord", F.col("ord").cast("bigint")).select(*_DUMP_COLS)


@query("src_dump_rejects", with_(OCC) + """
SELECT CASE WHEN gbifID % 29 = 0 THEN 4 ELSE 10 END AS fields, count(*) AS lines
FROM occ WHERE gbifID % 29 = 0 OR gbifID % 31 = 0 GROUP BY 1""")
def q_src_dump_rejects(spark, sf_dir):
    """A1: the malformed lines of a dump, counted by their number of fields."""
    _, bad = read_dump(spark, _dump(spark, sf_dir))
    return bad.groupBy(F.size(F.split(CORRUPT, "\t", -1)).alias("fields")).agg(F.count(F.lit(1)).alias("lines"))


@query("src_occurrence_scan", with_(OCC, """
occ_text AS (
  SELECT ord, CAST(gbifID AS VARCHAR) AS gbifID_t,
         CASE WHEN gbifID % 13 = 0 THEN 'n/a' ELSE CAST(decimalLatitude AS VARCHAR) END AS lat_t,
         CAST(decimalLongitude AS VARCHAR) AS lon_t, CAST(year AS VARCHAR) AS year_t, countryCode
  FROM occ)""") + """
SELECT ord, TRY_CAST(gbifID_t AS BIGINT) AS gbifID, TRY_CAST(lat_t AS DOUBLE) AS decimalLatitude,
       TRY_CAST(lon_t AS DOUBLE) AS decimalLongitude, TRY_CAST(year_t AS DOUBLE) AS year, countryCode
FROM occ_text""")
def q_src_occurrence_scan(spark, sf_dir):
    """A1: raw text columns (as a TSV dump delivers them) typed on read with
    try_cast; bad numbers become null."""
    from habiflow.sources import type_occurrence_text
    o = FX.occ(spark, sf_dir)
    text = o.select(
        "ord", F.col("gbifID").cast("string").alias("gbifID"),
        F.when(F.col("gbifID") % 13 == 0, F.lit("n/a"))
         .otherwise(F.col("decimalLatitude").cast("string")).alias("decimalLatitude"),
        F.col("decimalLongitude").cast("string").alias("decimalLongitude"),
        F.col("year").cast("string").alias("year"), "countryCode")
    return type_occurrence_text(text)


# ------------------------------------------------------------ filters ----

@query("flt_drop_all_null", with_(OCC) + """
SELECT ord, decimalLatitude, elevation, startDayOfYear FROM occ
WHERE NOT (decimalLatitude IS NULL AND elevation IS NULL AND startDayOfYear IS NULL)""")
def q_flt_drop_all_null(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "elevation", "startDayOfYear")
    return C.drop_all_null(o, ["decimalLatitude", "elevation", "startDayOfYear"])


@query("prj_fill_unknown", with_(OCC) + """
SELECT ord, coalesce(countryCode, 'Unknown') AS countryCode,
       coalesce(stateProvince, 'Unknown') AS stateProvince, coalesce(county, 'Unknown') AS county
FROM occ""")
def q_prj_fill_unknown(spark, sf_dir):
    return C.fill_unknown(FX.occ(spark, sf_dir).select("ord", "countryCode", "stateProvince", "county"))


@query("prj_ascii_clean", with_(OCC) + f"""
SELECT ord, {S.clean_state('stateProvince')} AS stateProvince FROM occ""")
def q_prj_ascii_clean(spark, sf_dir):
    return C.clean_state_names(FX.occ(spark, sf_dir).select("ord", "stateProvince"))


@query("prj_try_numeric", with_(OCC) + """
SELECT ord, TRY_CAST(CASE WHEN gbifID % 13 = 0 THEN 'n/a' ELSE CAST(decimalLatitude AS VARCHAR) END AS DOUBLE)
         AS decimalLatitude
FROM occ""")
def q_prj_try_numeric(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    t = o.select("ord", F.when(F.col("gbifID") % 13 == 0, F.lit("n/a"))
                 .otherwise(F.col("decimalLatitude").cast("string")).alias("decimalLatitude"))
    return C.coerce_numeric(t, ["decimalLatitude"])


@query("flt_geo_bounds", with_(OCC) + """
SELECT ord, decimalLatitude, decimalLongitude FROM occ
WHERE decimalLatitude IS NULL OR decimalLongitude IS NULL
   OR (decimalLatitude BETWEEN 24 AND 71 AND decimalLongitude BETWEEN -180 AND -66)""")
def q_flt_geo_bounds(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude")
    return C.filter_bounds_keep_missing(o)


@query("flt_country", with_(OCC) + """
SELECT ord, countryCode FROM occ WHERE upper(countryCode) IN ('US', 'USA', 'UNITED STATES')""")
def q_flt_country(spark, sf_dir):
    return C.filter_country(FX.occ(spark, sf_dir).select("ord", "countryCode"))


@query("flt_invalid_coords", with_(OCC) + """
SELECT ord, decimalLatitude, decimalLongitude FROM occ
WHERE NOT (decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND
           (decimalLatitude = 0 OR decimalLatitude > 90 OR decimalLatitude < -90 OR
            decimalLongitude = 0 OR decimalLongitude > 180 OR decimalLongitude < -180))""")
def q_flt_invalid_coords(spark, sf_dir):
    return C.drop_invalid_coords(FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude"))


@query("prj_round_coords", with_(OCC) + """
SELECT ord,
  CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL
       THEN round_even(decimalLatitude, 5) ELSE decimalLatitude END AS decimalLatitude,
  CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL
       THEN round_even(decimalLongitude, 5) ELSE decimalLongitude END AS decimalLongitude
FROM occ""")
def q_prj_round_coords(spark, sf_dir):
    return C.round_coords(FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude"))


@query("flt_continent_prefix", with_(OCC) + """
SELECT ord, continent, verbatimLocality FROM occ
WHERE NOT (continent IS NOT DISTINCT FROM 'ASIA')
  AND NOT coalesce(starts_with(verbatimLocality, 'Canada'), false)""")
def q_flt_continent_prefix(spark, sf_dir):
    return C.filter_continent_prefix(FX.occ(spark, sf_dir).select("ord", "continent", "verbatimLocality"))


_LOC = ("(decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL) OR "
        "coalesce(locality, verbatimLocality, municipality, county, stateProvince) IS NOT NULL")


@query("flt_coords_or_location", with_(OCC) + f"""
SELECT ord, gbifID FROM occ WHERE {_LOC}""")
def q_flt_coords_or_location(spark, sf_dir):
    return C.filter_coords_or_location(FX.occ(spark, sf_dir)).select("ord", "gbifID")


_BARE = ("county", "municipality", "stateProvince", "verbatimLocality")


@query("flt_removed_rows", with_(OCC, "occ2 AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN gbifID % 3 <> 0 THEN {c} END AS {c}" for c in _BARE) + ") FROM occ)") + f"""
SELECT ord, gbifID FROM occ2 WHERE NOT ({_LOC})""")
def q_flt_removed_rows(spark, sf_dir):
    """The rows that have neither coordinates nor any location text."""
    o = FX.occ(spark, sf_dir).withColumns({c: F.when(F.col("gbifID") % 3 != 0, F.col(c)) for c in _BARE})
    return C.removed_rows(o).select("ord", "gbifID")


@query("flt_time_bounds", with_(OCC, f"""
d AS (SELECT ord, {S.DATETIME} AS datetime FROM occ)""") + """
SELECT ord, datetime FROM d
WHERE CAST(datetime AS DATE) BETWEEN DATE '1979-01-01' AND DATE '2020-12-31'""")
def q_flt_time_bounds(spark, sf_dir):
    d = C.process_dates(FX.occ(spark, sf_dir)).select("ord", "datetime")
    return C.filter_time_bounds(d)


@query("flt_raster_bounds", with_(OCC, """
d AS (SELECT ord, decimalLatitude, decimalLongitude,
             try(make_timestamp(CAST(year AS BIGINT), CAST(month AS BIGINT), CAST(day AS BIGINT), 0, 0, 0)) AS datetime
      FROM occ),
f AS (SELECT max(CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL THEN 1 ELSE 0 END)
             * max(CASE WHEN datetime IS NOT NULL THEN 1 ELSE 0 END) AS active FROM d)""") + """
SELECT ord, decimalLatitude, decimalLongitude, datetime FROM d, f
WHERE f.active = 0 OR decimalLatitude IS NULL OR decimalLongitude IS NULL
   OR coalesce(decimalLatitude BETWEEN 25.067 AND 49.4 AND decimalLongitude BETWEEN -124.8 AND -67.06
      AND datetime BETWEEN TIMESTAMP '1979-01-01' AND TIMESTAMP '2020-12-31', false)""")
def q_flt_raster_bounds(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude", "year", "month", "day")
    return C.filter_grid_bounds(o).select("ord", "decimalLatitude", "decimalLongitude", "datetime")


@query("flt_region_bbox", with_(OCC) + """
SELECT ord, decimalLatitude, decimalLongitude FROM occ
WHERE decimalLatitude BETWEEN 42.0 AND 49.0 AND decimalLongitude BETWEEN -117.24 AND -111.04""")
def q_flt_region_bbox(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude")
    return C.filter_bbox(o, 42.0, 49.0, -117.24, -111.04)


@query("flt_threshold", with_(FX.SCORED_SQL) + """
SELECT ord, probability FROM scored WHERE probability >= 0.8""")
def q_flt_threshold(spark, sf_dir):
    return C.filter_threshold(FX.scored(spark, sf_dir).select("ord", "probability"), 0.8)


@query("prj_essential_columns", with_(OCC, S.clean_ctes()) + """
SELECT ord, decimalLatitude, decimalLongitude, year, month, day, datetime, occurrence, season_num FROM clean""")
def q_prj_essential_columns(spark, sf_dir):
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    return C.select_available(c, ("ord",) + C.ESSENTIAL_COLUMNS + ("not_a_column",))


@query("prj_drop_columns", with_(OCC) + """
SELECT * EXCLUDE (eventDate, verbatimEventDate, dateIdentified, startDayOfYear, continent) FROM occ""")
def q_prj_drop_columns(spark, sf_dir):
    return C.drop_columns(FX.occ(spark, sf_dir), ["eventDate", "verbatimEventDate", "dateIdentified",
                                                  "startDayOfYear", "continent", "absent_column"])


@query("flt_drop_any_null", with_(OCC) + """
SELECT ord, decimalLatitude, decimalLongitude, municipality FROM occ
WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND municipality IS NOT NULL""")
def q_flt_drop_any_null(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude", "municipality")
    return C.drop_any_null(o, ["decimalLatitude", "decimalLongitude", "municipality"])


@query("flt_missing_coords", with_(OCC) + """
SELECT ord, gbifID, locality FROM occ WHERE decimalLatitude IS NULL AND decimalLongitude IS NULL""")
def q_flt_missing_coords(spark, sf_dir):
    return C.missing_coords(FX.occ(spark, sf_dir)).select("ord", "gbifID", "locality")


def _usable_sql(c: str) -> str:
    lst = ", ".join(f"'{s}'" for s in C.SENTINEL_TEXTS)
    return f"coalesce(lower(trim({c})) NOT IN ({lst}) AND length(trim({c})) > 5, false)"


@query("flt_sentinel_text", with_(OCC) + f"""
SELECT ord, {_usable_sql('locality')} AS locality_usable,
       {_usable_sql('verbatimLocality')} AS verbatimLocality_usable FROM occ""")
def q_flt_sentinel_text(spark, sf_dir):
    o = FX.occ(spark, sf_dir).select("ord", "locality", "verbatimLocality")
    return C.sentinel_flags(o).select("ord", "locality_usable", "verbatimLocality_usable")


@query("flt_basis_recent", with_(OCC, f"""
d AS (SELECT ord, basisOfRecord, CAST(year({S.DATETIME}) AS DOUBLE) AS year FROM occ)""") + """
SELECT ord, basisOfRecord, year FROM d
WHERE basisOfRecord IN ('HumanObservation', 'PreservedSpecimen') AND year >= 2000""")
def q_flt_basis_recent(spark, sf_dir):
    d = C.process_dates(FX.occ(spark, sf_dir)).select("ord", "basisOfRecord", "year")
    return C.filter_basis_recent(d)


@query("prj_fill_zero", with_(OCC) + """
SELECT ord, coalesce(elevation, 0) AS elevation, coalesce(startDayOfYear, 0) AS startDayOfYear FROM occ""")
def q_prj_fill_zero(spark, sf_dir):
    return C.fill_zero(FX.occ(spark, sf_dir).select("ord", "elevation", "startDayOfYear"),
                       ["elevation", "startDayOfYear"])


@query("clean_occurrences", with_(OCC, S.clean_ctes()) + """
SELECT * FROM clean""")
def q_clean_occurrences(spark, sf_dir):
    """L1 end to end."""
    return C.clean_occurrences(FX.occ(spark, sf_dir))


@query("win_dedup_keep_first", with_(OCC) + """
SELECT * FROM occ QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY ord) = 1""")
def q_win_dedup_keep_first(spark, sf_dir):
    return C.dedup_keep_first(FX.occ(spark, sf_dir))


# ---------------------------------------------------------- functions ----

@query("fn_multi_source_date", with_(OCC) + f"""
SELECT ord, {S.DATETIME} AS datetime FROM occ""")
def q_fn_multi_source_date(spark, sf_dir):
    return FX.occ(spark, sf_dir).select("ord", H.multi_source_datetime().alias("datetime"))


@query("fn_day_of_year", with_(OCC) + """
SELECT ord, try(make_timestamp(CAST(year AS BIGINT), 1, 1, 0, 0, 0)) + to_days(CAST(startDayOfYear AS INTEGER) - 1)
         AS doy_date,
       try(make_timestamp(CAST(year AS BIGINT), 1, 1, 0, 0, 0)) + to_days(CAST(startDayOfYear AS INTEGER) + 400 - 1)
         AS doy_rollover
FROM occ""")
def q_fn_day_of_year(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    return o.select("ord", H.day_of_year_date("year", "startDayOfYear").alias("doy_date"),
                    H.day_of_year_date("year", F.col("startDayOfYear") + 400).alias("doy_rollover"))


@query("fn_date_parts", with_(OCC, f"""
d AS (SELECT ord, {S.DATETIME} AS datetime FROM occ)""") + """
SELECT ord, CAST(year(datetime) AS INTEGER) AS y, CAST(month(datetime) AS INTEGER) AS m,
       CAST(day(datetime) AS INTEGER) AS d FROM d""")
def q_fn_date_parts(spark, sf_dir):
    d = FX.occ(spark, sf_dir).select("ord", H.multi_source_datetime().alias("datetime"))
    return d.select("ord", F.year("datetime").alias("y"), F.month("datetime").alias("m"),
                    F.dayofmonth("datetime").alias("d"))


@query("fn_season", with_(OCC) + f"""
SELECT ord, month, {S.season('month')} AS season_num,
       CASE {S.season('month')} WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer'
            WHEN 3 THEN 'Fall' END AS season_name
FROM occ""")
def q_fn_season(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    return o.select("ord", "month", H.season_num("month").alias("season_num"),
                    H.season_name("month").alias("season_name"))


@query("fn_quarter_season", with_(OCC) + """
SELECT ord, month, CASE WHEN month BETWEEN 1 AND 12 THEN CAST(floor((month - 1) / 3) AS INTEGER) + 1 END AS quarter_season
FROM occ""")
def q_fn_quarter_season(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    return o.select("ord", "month", H.season_num("month", mode="quarter").alias("quarter_season"))


@query("fn_safe_datetime", with_(OCC) + f"""
SELECT ord, coalesce({S.full_date('coalesce(eventDate, verbatimEventDate, dateIdentified)')},
                     {S.verbatim('coalesce(eventDate, verbatimEventDate, dateIdentified)')}) AS parsed
FROM occ""")
def q_fn_safe_datetime(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    src = F.coalesce("eventDate", "verbatimEventDate", "dateIdentified")
    return o.select("ord", H.safe_datetime(src).alias("parsed"))


@query("fn_string_clean", with_(OCC) + f"""
SELECT ord, {S.clean_state('stateProvince')} AS state_clean, upper(countryCode) AS country_upper,
       lower(trim(locality)) AS locality_norm, starts_with(verbatimLocality, 'Canada') AS is_canada,
       CAST(length(trim(municipality)) AS INTEGER) AS municipality_len
FROM occ""")
def q_fn_string_clean(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    return o.select("ord", H.clean_state("stateProvince").alias("state_clean"),
                    F.upper("countryCode").alias("country_upper"),
                    F.lower(F.trim("locality")).alias("locality_norm"),
                    F.col("verbatimLocality").startswith("Canada").alias("is_canada"),
                    F.length(F.trim("municipality")).alias("municipality_len"))


@query("fn_concat_nonnull", with_(OCC) + """
SELECT ord, nullif(concat_ws(', ', locality, municipality, county, stateProvince, countryCode), '') AS full_string
FROM occ""")
def q_fn_concat_nonnull(spark, sf_dir):
    o = FX.occ(spark, sf_dir)
    return o.select("ord", H.concat_nonnull("locality", "municipality", "county", "stateProvince",
                                            "countryCode").alias("full_string"))


def _first_line_sql(x: str) -> str:
    skip = " AND ".join(f"NOT starts_with(l, '{p}')" for p in H.ANSWER_SKIP_PREFIXES)
    lines = f"list_transform(string_split({S.strip(x)}, chr(10)), lambda s: {S.strip('s')})"
    return (f"coalesce(list_filter({lines}, lambda l: length(l) > 2 AND {skip})[1], "
            f"list_filter({lines}, lambda l: length(l) > 2)[-1])")


@query("fn_first_clean_line", """
SELECT conv_id, turn, """ + _first_line_sql("text") + """ AS answer
FROM conversations""")
def q_fn_first_clean_line(spark, sf_dir):
    c = FX.read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", H.first_clean_line("text").alias("answer"))


@query("fn_haversine", with_(FX.SCORED_SQL) + """
SELECT ord, 2 * 6371.0 * asin(sqrt(pow(sin((radians(47.0) - radians(decimalLatitude)) / 2), 2)
       + cos(radians(decimalLatitude)) * cos(radians(47.0))
       * pow(sin((radians(-116.0) - radians(decimalLongitude)) / 2), 2))) AS dist_km
FROM scored""")
def q_fn_haversine(spark, sf_dir):
    s = FX.scored(spark, sf_dir)
    return s.select("ord", H.haversine_km("decimalLatitude", "decimalLongitude",
                                          F.lit(47.0), F.lit(-116.0)).alias("dist_km"))


@query("fn_unit_conversions", with_(FX.RASTER_SQL) + """
SELECT itime, ilat, ilon,
  air_temperature - 273.15 AS air_temperature_c,
  (air_temperature - 273.15) * 9.0 / 5.0 + 32.0 AS air_temperature_f,
  precipitation_amount * 1000.0 AS precipitation_mm,
  precipitation_amount / 25.4 AS precipitation_in,
  relative_humidity * 100.0 AS relative_humidity_pct,
  CASE WHEN NOT isnan(wind_speed) THEN wind_speed * 2.237 END AS wind_speed_mph
FROM raster""")
def q_fn_unit_conversions(spark, sf_dir):
    r = FX.cube(spark, sf_dir)
    return r.select("itime", "ilat", "ilon",
                    H.kelvin_to_c("air_temperature").alias("air_temperature_c"),
                    H.kelvin_to_f("air_temperature").alias("air_temperature_f"),
                    H.metres_to_mm("precipitation_amount").alias("precipitation_mm"),
                    H.mm_to_inch("precipitation_amount").alias("precipitation_in"),
                    H.fraction_to_percent("relative_humidity").alias("relative_humidity_pct"),
                    F.when(~F.isnan("wind_speed"), H.ms_to_mph("wind_speed")).alias("wind_speed_mph"))


@query("fn_cell_area", with_(FX.RASTER_SQL) + """
SELECT itime, ilat, ilon,
  abs((6371000.0 * radians(2.0)) * (6371000.0 * radians(2.0) * cos(radians(lat)))) AS cell_area_m2
FROM raster""")
def q_fn_cell_area(spark, sf_dir):
    r = FX.cube(spark, sf_dir)
    return r.select("itime", "ilat", "ilon", H.cell_area_m2(F.col("lat"), 2.0, 2.0).alias("cell_area_m2"))


@query("fn_popup_text", with_(FX.SCORED_SQL) + """
SELECT ord, printf('Probability: %.2f%%<br>Lat: %.4f<br>Lon: %.4f', probability * 100.0,
                   decimalLatitude, decimalLongitude) AS popup
FROM scored""")
def q_fn_popup_text(spark, sf_dir):
    s = FX.scored(spark, sf_dir)
    return s.select("ord", H.popup_text("decimalLatitude", "decimalLongitude", "probability").alias("popup"))


@query("fn_marker_json")
def q_fn_marker_json(spark, sf_dir):
    """GeoJSON-like features of rows above the threshold (text
    formatting of doubles differs between engines: rows-only check)."""
    s = C.filter_threshold(FX.scored(spark, sf_dir), 0.8)
    return s.select("ord", H.marker_json("decimalLatitude", "decimalLongitude", "probability").alias("feature"))
