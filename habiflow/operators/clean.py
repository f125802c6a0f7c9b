"""Cleaning filters, projections and the keep-first de-duplication
(SURVEY B1-B26, H4-H7, E1; composite job L1).

All functions are narrow transformations (no shuffle) except
:func:`dedup_keep_first`, which shuffles once on the id.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow import functions as H

LAT, LON = "decimalLatitude", "decimalLongitude"

# --- fixed values that must equal the reference's (do not edit) ----------
US_BOUNDS = {"lat_min": 24.0, "lat_max": 71.0, "lon_min": -180.0, "lon_max": -66.0}
GRID_BOUNDS = {"lat_min": 25.067, "lat_max": 49.4, "lon_min": -124.8, "lon_max": -67.06,
               "time_min": "1979-01-01", "time_max": "2020-12-31"}
REQUIRED_COLUMNS = ("decimalLatitude", "decimalLongitude", "year", "month", "day",
                    "stateProvince")
GATE_COLUMNS = ("eventDate", "countryCode", "county")
ESSENTIAL_COLUMNS = ("decimalLatitude", "decimalLongitude", "year", "month", "day",
                     "datetime", "occurrence", "season_num")
LOCATION_FIELDS = ("locality", "verbatimLocality", "municipality", "county", "stateProvince")
SENTINEL_TEXTS = ("no specific locality recorded", "no locality recorded",
                  "no verbatim locality recorded", "nan", "none", "")
# --------------------------------------------------------------------------


def has_coords(lat: str = LAT, lon: str = LON) -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def require_columns(df: DataFrame, required: Iterable[str] = GATE_COLUMNS) -> DataFrame:
    """Required-column gate (A2): raise listing every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """'Available columns only' projection."""
    return df.select(*[c for c in wanted if c in df.columns])


# --- fixed values that must equal the reference's (do not edit) ----------
MODELING_ESSENTIAL = ("decimalLatitude", "decimalLongitude", "year", "month", "day", "datetime", "occurrence", "season_num")
MODELING_ENVIRONMENT = ("elevation", "soil_ph", "gridmet_lat", "gridmet_lon", "gridmet_date")
# --------------------------------------------------------------------------


def modeling_columns(df: DataFrame, variables: Sequence[str], target: str = "occurrence") -> tuple[DataFrame, list[str]]:
    """Essential, environmental and climate columns that are there, and the essential ones that are not.

    Missing essential columns are also a warning; without the target there is
    nothing to train on, which is an error.
    """
    missing = [c for c in MODELING_ESSENTIAL if c not in df.columns]
    if target in missing:
        raise ValueError(f"no target column {target}")
    if missing:
        warnings.warn(f"Missing essential columns: {missing}", stacklevel=2)
    return select_available(df, [*MODELING_ESSENTIAL, *MODELING_ENVIRONMENT, *variables]), missing


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lenient drop-list projection (B17): absent names are ignored."""
    return df.drop(*cols)


# ------------------------------------------------------------ filters ----

def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """B1: drop rows where every (subset) column is null."""
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows null in any (subset) column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_unknown(df: DataFrame, cols: Sequence[str] = ("countryCode", "stateProvince", "county"),
                 value: str = "Unknown") -> DataFrame:
    """B2."""
    return df.na.fill({c: value for c in cols if c in df.columns})


def clean_state_names(df: DataFrame, col: str = "stateProvince") -> DataFrame:
    """Non-ASCII removed, one '  '->' ' pass, trimmed."""
    return df.withColumn(col, H.clean_state(col))


def coerce_numeric(df: DataFrame, cols: Sequence[str] = (LAT, LON)) -> DataFrame:
    """Bad numbers and NaN become null (try_cast, ANSI-safe)."""
    return df.select(*[H.nan_to_null(F.col(c).try_cast("double")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def filter_bounds_keep_missing(df: DataFrame, bounds: dict = US_BOUNDS,
                               lat: str = LAT, lon: str = LON) -> DataFrame:
    """Inside the box (inclusive), or either coordinate null."""
    inside = (F.col(lat).between(bounds["lat_min"], bounds["lat_max"])
              & F.col(lon).between(bounds["lon_min"], bounds["lon_max"]))
    return df.filter(~has_coords(lat, lon) | inside)


def filter_country(df: DataFrame, col: str = "countryCode",
                   accepted: Sequence[str] = H.US_COUNTRY_VALUES) -> DataFrame:
    """Case-insensitive country membership; null drops."""
    return df.filter(F.upper(F.col(col)).isin(*accepted))


def drop_invalid_coords(df: DataFrame, lat: str = LAT, lon: str = LON) -> DataFrame:
    """Zero or out-of-range coordinates, tested only when both present."""
    la, lo = F.col(lat), F.col(lon)
    bad = ((la == 0) | (la > 90) | (la < -90) | (lo == 0) | (lo > 180) | (lo < -180))
    return df.filter(~(has_coords(lat, lon) & bad))


def round_coords(df: DataFrame, digits: int = 5, lat: str = LAT, lon: str = LON) -> DataFrame:
    """Half-even rounding where both coordinates are present."""
    both = has_coords(lat, lon)
    return (df.withColumn(lat, F.when(both, F.bround(lat, digits)).otherwise(F.col(lat)))
              .withColumn(lon, F.when(both, F.bround(lon, digits)).otherwise(F.col(lon))))


def filter_continent_prefix(df: DataFrame, continent: str = "ASIA",
                            prefix: str = "Canada") -> DataFrame:
    """Drop continent == ASIA and verbatimLocality starting 'Canada';
    nulls pass both tests."""
    return df.filter(~F.col("continent").eqNullSafe(continent)
                     & ~F.coalesce(F.col("verbatimLocality").startswith(prefix), F.lit(False)))


def coords_or_location(lat: str = LAT, lon: str = LON,
                       fields: Sequence[str] = LOCATION_FIELDS) -> Column:
    return has_coords(lat, lon) | F.coalesce(*[F.col(f) for f in fields]).isNotNull()


def filter_coords_or_location(df: DataFrame) -> DataFrame:
    """Keep rows with both coordinates or any location text."""
    return df.filter(coords_or_location())


def removed_rows(df: DataFrame) -> DataFrame:
    """B10 inverse: the rows B10 removes (report)."""
    return df.filter(~coords_or_location())


def filter_time_bounds(df: DataFrame, col: str = "datetime",
                       start: str = GRID_BOUNDS["time_min"],
                       end: str = GRID_BOUNDS["time_max"]) -> DataFrame:
    """Start <= date(datetime) <= end; null drops.  Compared on date
    granularity (per-row parsed timestamps may carry a time of day)."""
    return df.filter(F.to_date(F.col(col)).between(F.lit(start).cast("date"),
                                                   F.lit(end).cast("date")))


def filter_grid_bounds(df: DataFrame, bounds: dict = GRID_BOUNDS,
                       lat: str = LAT, lon: str = LON) -> DataFrame:
    """Rebuild datetime from year/month/day, keep rows inside the box and
    the date range, or rows without coordinates.  When no row has both
    coordinates and a date, nothing is filtered (reference behaviour): this
    is a window-free global test expressed as a one-row aggregate joined
    back as a broadcast."""
    d = H.ymd_timestamp("year", "month", "day")
    x = df.withColumn("datetime", d)
    inside = (F.col(lat).between(bounds["lat_min"], bounds["lat_max"])
              & F.col(lon).between(bounds["lon_min"], bounds["lon_max"])
              & F.col("datetime").between(F.lit(bounds["time_min"]).cast("timestamp"),
                                          F.lit(bounds["time_max"]).cast("timestamp")))
    flag = x.agg((F.max(has_coords(lat, lon).cast("int")) * F.max(
        F.col("datetime").isNotNull().cast("int"))).alias("__active"))
    return (x.crossJoin(F.broadcast(flag))
            .filter((F.col("__active") == 0) | ~has_coords(lat, lon) | F.coalesce(inside, F.lit(False)))
            .drop("__active"))


def filter_bbox(df: DataFrame, lat_min: float, lat_max: float, lon_min: float,
                lon_max: float, lat: str = LAT, lon: str = LON) -> DataFrame:
    """Inclusive bounding box."""
    return df.filter(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def filter_threshold(df: DataFrame, threshold: float = 0.8, col: str = "probability") -> DataFrame:
    """Probability >= threshold."""
    return df.filter(F.col(col) >= threshold)


def missing_coords(df: DataFrame, lat: str = LAT, lon: str = LON) -> DataFrame:
    """Rows lacking both coordinates."""
    return df.filter(F.col(lat).isNull() & F.col(lon).isNull())


def sentinel_flags(df: DataFrame, cols: Sequence[str] = ("locality", "verbatimLocality"),
                   min_len: int = 5) -> DataFrame:
    """Per text column, is it a sentinel / too short (``<col>_usable``)."""
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_usable", ~H.is_sentinel(c, SENTINEL_TEXTS, min_len))
    return out


def filter_basis_recent(df: DataFrame, min_year: int = 2000,
                        basis: Sequence[str] = ("HumanObservation", "PreservedSpecimen")) -> DataFrame:
    """B26 [plan]: basisOfRecord in the list and year >= min_year."""
    return df.filter(F.col("basisOfRecord").isin(*basis) & (F.col("year") >= min_year))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Impute missing features with 0 (scoring only)."""
    return df.na.fill(0, subset=[c for c in cols if c in df.columns])


# ------------------------------------------------------------- dates ----

def process_dates(df: DataFrame) -> DataFrame:
    """H4 + H6 + H7: per-row date cascade, components and season.

    Sources missing from the frame are skipped.  year/month/day are
    overwritten from the final datetime (null when no source parsed).
    """
    c = set(df.columns)
    dt = H.multi_source_datetime(
        "eventDate" if "eventDate" in c else None,
        "year" if "year" in c else None, "month" if "month" in c else None,
        "day" if "day" in c else None,
        "startDayOfYear" if "startDayOfYear" in c else None,
        "verbatimEventDate" if "verbatimEventDate" in c else None,
        "dateIdentified" if "dateIdentified" in c else None)
    return (df.withColumn("datetime", dt)
              .withColumn("year", F.year("datetime").cast("double"))
              .withColumn("month", F.month("datetime").cast("double"))
              .withColumn("day", F.dayofmonth("datetime").cast("double"))
              .withColumn("season_num", H.season_num("month")))


# -------------------------------------------------------------- dedup ----

def dedup_keep_first(df: DataFrame, key: str = "gbifID", order: str = "ord") -> DataFrame:
    """One row per key, the first in ingest order; null keys collapse
    into one row.

    Expressed as ``min_by(struct(row), order)`` grouped by key, not as a
    ``row_number`` window: the aggregate combines map-side, so a hot key
    (e.g. a third of all rows with a null id) reaches the reducer as one row
    per map task instead of one whole group in one task.
    """
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in others]),
                                       F.col(order)).alias("__r"))
    return agg.select(F.col(key), *[F.col("__r")[c].alias(c) for c in others]).select(*df.columns)


# ---------------------------------------------------------------- job ----

def clean_occurrences(df: DataFrame, time_filter: bool = True) -> DataFrame:
    """L1: the cleaning chain in reference order.

    B1 B2 B3 -> B4 B5 -> B6 -> B7 B8 -> H4 H6 H7 -> E1 -> label 1 -> B11.
    Same semantics as chaining the single operators above, expressed as a
    handful of projections and one filter so the plan is built once.
    """
    cols = df.columns
    x = drop_all_null(df)
    fill = {"countryCode", "stateProvince", "county"}
    first = []
    for c in cols:
        e = F.col(c)
        if c in fill:
            e = F.coalesce(e, F.lit("Unknown"))
        if c == "stateProvince":
            e = H.clean_state(e)
        if c in (LAT, LON):
            e = e.try_cast("double")
        first.append(e.alias(c))
    x = x.select(*first)
    la, lo = F.col(LAT), F.col(LON)
    both = la.isNotNull() & lo.isNotNull()
    inside = (la.between(US_BOUNDS["lat_min"], US_BOUNDS["lat_max"])
              & lo.between(US_BOUNDS["lon_min"], US_BOUNDS["lon_max"]))
    bad = (la == 0) | (la > 90) | (la < -90) | (lo == 0) | (lo > 180) | (lo < -180)
    x = x.filter((~both | inside) & F.upper(F.col("countryCode")).isin(*H.US_COUNTRY_VALUES) & ~(both & bad))
    c2 = set(cols)
    dt = H.multi_source_datetime(
        "eventDate" if "eventDate" in c2 else None,
        "year" if "year" in c2 else None, "month" if "month" in c2 else None,
        "day" if "day" in c2 else None,
        "startDayOfYear" if "startDayOfYear" in c2 else None,
        "verbatimEventDate" if "verbatimEventDate" in c2 else None,
        "dateIdentified" if "dateIdentified" in c2 else None)
    x = x.select(*[F.when(both, F.bround(c, 5)).otherwise(F.col(c)).alias(c) if c in (LAT, LON) else F.col(c)
                   for c in cols if c not in ("year", "month", "day")], dt.alias("datetime"))
    x = x.select("*", F.year("datetime").cast("double").alias("year"),
                 F.month("datetime").cast("double").alias("month"),
                 F.dayofmonth("datetime").cast("double").alias("day"),
                 H.season_num(F.month("datetime")).alias("season_num"))
    x = x.select(*cols, "datetime", "season_num")
    x = dedup_keep_first(x) if "ord" in x.columns else x
    keep = F.lit(True)
    if time_filter:
        keep = F.to_date(F.col("datetime")).between(F.lit(GRID_BOUNDS["time_min"]).cast("date"),
                                                    F.lit(GRID_BOUNDS["time_max"]).cast("date"))
    return x.filter(keep).select("*", F.lit(1).alias("occurrence"))
