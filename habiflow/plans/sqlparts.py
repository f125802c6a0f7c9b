"""DuckDB SQL twins of the Spark operators, used only by the oracle.

Each function returns CTE text.  The oracle reads the same driver tables as
the Spark queries; these strings restate the operator semantics in plain
SQL so the driver can compare results.
"""

from __future__ import annotations

from habiflow.plans import fixtures as FX
from habiflow.operators.raster import RasterSpec

VARS = FX.CLIMATE_VARS

OCC_COLS = ("ord, gbifID, decimalLatitude, decimalLongitude, eventDate, year, month, day, "
            "startDayOfYear, verbatimEventDate, dateIdentified, countryCode, stateProvince, county, "
            "municipality, locality, verbatimLocality, continent, basisOfRecord, elevation")


def full_date(x: str) -> str:
    t = f"regexp_replace(trim({x}), '(\\.\\d{{6}})\\d+', '\\1')"
    t = (f"regexp_replace({t}, '([T ]\\d{{1,2}}:\\d{{1,2}}(?::\\d{{1,2}}(?:\\.\\d{{1,6}})?)?)"
         f"(?:Z|[+-]\\d{{2}}(?::?\\d{{2}})?)$', '\\1')")
    forms = [f"try_strptime({t}, '%Y-%m-%d{sep}%H:%M{sec}')" for sep in ("T", " ") for sec in (":%S", "", ":%S.%f")]
    return f"CASE WHEN length({t}) >= 10 THEN coalesce({', '.join(forms)}, try_strptime({t}, '%Y-%m-%d')) END"


def verbatim(x: str) -> str:
    t = f"trim({x})"
    return (f"coalesce(try_strptime({t}, '%Y %b %d'), try_strptime({t}, '%Y-%m-%d'), "
            f"try_strptime({t}, '%Y/%m/%d'))")


DATETIME = f"""coalesce(
      {full_date('eventDate')},
      CASE WHEN year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
           THEN try(make_timestamp(CAST(year AS BIGINT), CAST(month AS BIGINT), CAST(day AS BIGINT), 0, 0, 0)) END,
      CASE WHEN year IS NOT NULL AND startDayOfYear IS NOT NULL
           THEN try(make_timestamp(CAST(year AS BIGINT), 1, 1, 0, 0, 0)) + to_days(CAST(startDayOfYear AS INTEGER) - 1) END,
      {verbatim('verbatimEventDate')},
      {full_date('dateIdentified')})"""


def season(month: str) -> str:
    return f"CASE WHEN {month} BETWEEN 1 AND 12 THEN CAST(floor((CAST({month} AS INTEGER) % 12) / 3) AS INTEGER) END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\x09-\\x0D\\x1C-\\x20]+|[\\x09-\\x0D\\x1C-\\x20]+$', '', 'g')"


def clean_state(x: str) -> str:
    return strip(f"replace(regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g'), '  ', ' ')")


def clean_ctes(src: str = "occ", time_filter: bool = True, name: str = "clean", dedup: bool = True) -> str:
    """L1 as CTEs; the final CTE is ``name``."""
    tf = ("WHERE CAST(datetime AS DATE) BETWEEN DATE '1979-01-01' AND DATE '2020-12-31'"
          if time_filter else "")
    return f"""
l1_a AS (
  SELECT ord, gbifID, TRY_CAST(decimalLatitude AS DOUBLE) AS decimalLatitude,
         TRY_CAST(decimalLongitude AS DOUBLE) AS decimalLongitude, eventDate, year, month, day,
         startDayOfYear, verbatimEventDate, dateIdentified,
         coalesce(countryCode, 'Unknown') AS countryCode,
         {clean_state("coalesce(stateProvince, 'Unknown')")} AS stateProvince,
         coalesce(county, 'Unknown') AS county,
         municipality, locality, verbatimLocality, continent, basisOfRecord, elevation
  FROM {src}
),
l1_b AS (
  SELECT * FROM l1_a
  WHERE (decimalLatitude IS NULL OR decimalLongitude IS NULL
         OR (decimalLatitude BETWEEN 24 AND 71 AND decimalLongitude BETWEEN -180 AND -66))
    AND upper(countryCode) IN ('US', 'USA', 'UNITED STATES')
    AND NOT (decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND
             (decimalLatitude = 0 OR decimalLatitude > 90 OR decimalLatitude < -90 OR
              decimalLongitude = 0 OR decimalLongitude > 180 OR decimalLongitude < -180))
),
l1_c AS (
  SELECT * REPLACE (
    CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL
         THEN round_even(decimalLatitude, 5) ELSE decimalLatitude END AS decimalLatitude,
    CASE WHEN decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL
         THEN round_even(decimalLongitude, 5) ELSE decimalLongitude END AS decimalLongitude),
    {DATETIME} AS datetime
  FROM l1_b
),
l1_d AS (
  SELECT * REPLACE (CAST(year(datetime) AS DOUBLE) AS year, CAST(month(datetime) AS DOUBLE) AS month,
                    CAST(day(datetime) AS DOUBLE) AS day),
         {season('month(datetime)')} AS season_num
  FROM l1_c
),
l1_e AS (
  SELECT * FROM l1_d {"QUALIFY row_number() OVER (PARTITION BY gbifID ORDER BY ord) = 1" if dedup else ""}
),
{name} AS (
  SELECT *, 1 AS occurrence FROM l1_e {tf}
)"""


def time_max_sql(step_days: int = FX.TIME_STEP_DAYS) -> str:
    return (f"(TIMESTAMP '{FX.TIME_ORIGIN} 00:00:00' + to_days(CAST(((SELECT count(*) FROM customer) - 1)"
            f" * {step_days} AS INTEGER)))")


def spec_for_sql() -> RasterSpec:
    """A spec whose time size is a SQL scalar; only index text uses it."""
    return RasterSpec(FX.LAT_AXIS, FX.LON_AXIS, FX.TIME_ORIGIN, FX.TIME_STEP_DAYS, 0, VARS)


def time_index_sql(ts: str) -> str:
    step = float(FX.TIME_STEP_DAYS * 86400)
    return (f"LEAST(GREATEST(CAST(ceil((epoch(CAST({ts} AS TIMESTAMP)) - "
            f"epoch(TIMESTAMP '{FX.TIME_ORIGIN} 00:00:00')) / {step} - 0.5) AS INTEGER), 0), "
            f"(SELECT count(*) FROM customer) - 1)")


def nearest_join_ctes(src: str, name: str = "joined", datetime_col: str | None = "datetime",
                      target_date: str | None = None, keep: str = "*",
                      lat: str = "decimalLatitude", lon: str = "decimalLongitude") -> str:
    """C1/C2 as CTEs over the fixture raster CTE ``raster``."""
    tmin = f"TIMESTAMP '{FX.TIME_ORIGIN} 00:00:00'"
    tmax = time_max_sql()
    if target_date is not None:
        t = f"TIMESTAMP '{target_date} 00:00:00'"
        eff = f"CASE WHEN {t} BETWEEN {tmin} AND {tmax} THEN {t} ELSE {tmax} END"
        tcond = "TRUE"
    elif datetime_col is not None:
        eff = f"CAST({datetime_col} AS TIMESTAMP)"
        tcond = f"{eff} BETWEEN {tmin} AND {tmax}"
    else:
        eff, tcond = tmax, "TRUE"
    la, lo = FX.LAT_AXIS, FX.LON_AXIS
    ok = " AND ".join(f"r.{v} IS NOT NULL AND NOT isnan(r.{v})" for v in VARS)
    vars_ = ", ".join(f"r.{v}" for v in VARS)
    return f"""
{name}_k AS (
  SELECT {keep}, {la.sql_index(lat)} AS k_ilat, {lo.sql_index(lon)} AS k_ilon,
         {time_index_sql(eff)} AS k_itime
  FROM {src}
  WHERE {lat} BETWEEN {la.lo} AND {la.hi} AND {lon} BETWEEN {lo.lo} AND {lo.hi} AND {tcond}
),
{name} AS (
  SELECT p.* EXCLUDE (k_ilat, k_ilon, k_itime),
         CAST({la.origin} AS DOUBLE) + CAST({la.step} AS DOUBLE) * p.k_ilat AS gridmet_lat,
         CAST({lo.origin} AS DOUBLE) + CAST({lo.step} AS DOUBLE) * p.k_ilon AS gridmet_lon,
         CAST(DATE '{FX.TIME_ORIGIN}' + CAST(p.k_itime * {FX.TIME_STEP_DAYS} AS INTEGER) AS DATE) AS gridmet_date,
         {vars_}
  FROM {name}_k p JOIN raster r ON r.itime = p.k_itime AND r.ilat = p.k_ilat AND r.ilon = p.k_ilon
  WHERE {ok}
)"""


def raster_clean_cte(name: str = "rc") -> str:
    """Raster with NaN -> NULL on every variable."""
    cols = ", ".join(f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END AS {v}" for v in VARS)
    return f"""
{name} AS (SELECT itime, ilat, ilon, time, lat, lon, {cols} FROM raster)"""
