"""Scalar column functions.

Every function here returns a ``pyspark.sql.Column`` built only from
Spark built-ins, so it stays inside whole-stage codegen.  No Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str

EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_M = 6.371e6

# --- fixed values that must equal the reference's (do not edit) ----------
# Sentinel texts treated as "no locality" for the verbatim locality field.
VERBATIM_SENTINELS = ("no verbatim locality recorded", "nan", "none", "")
# Sentinel texts treated as "no locality" for the locality field.
LOCALITY_SENTINELS = ("no specific locality recorded", "no locality recorded",
                      "nan", "none", "")
# Sentinels for the landmark source when it comes from verbatimLocality.
VERBATIM_LANDMARK_SENTINELS = ("no verbatim locality recorded",
                               "no locality recorded", "nan", "none", "")
# Sentinels for the municipality field.
MUNICIPALITY_SENTINELS = ("nan", "none", "")
# Line prefixes skipped when cleaning a free-text landmark answer.
ANSWER_SKIP_PREFIXES = ("The most specific", "Answer:", "Return",
                        "For example", "Based on", "Given", "Location:",
                        "Prioritize", "1.", "2.", "3.", "4.", "-", "If no")
# Country values accepted as the United States (compared upper-case).
US_COUNTRY_VALUES = ("US", "USA", "UNITED STATES")
# Season names by code 0..3 (meteorological seasons).
SEASON_NAMES = ("Winter", "Spring", "Summer", "Fall")
# Seasonal-mean order for the DJF/MAM/JJA/SON grouping.
SEASON_ORDER = ("DJF", "MAM", "JJA", "SON")
# Unit factors.
MS_TO_MPH = 2.237
M_TO_FT = 3.28084
# --------------------------------------------------------------------------


def col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- hashing --

def uniform(salt: str, *keys: ColLike) -> Column:
    """Deterministic uniform in [0, 1) from md5(salt ':' key).

    Independent of partitioning and reproducible in plain SQL (the first
    32 bits of the md5 digest divided by 2^32).  Several key parts are
    joined with ':'.
    """
    parts = [F.lit(salt), F.lit(":")]
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit(":"))
        parts.append(col(k).cast("string"))
    h = F.md5(F.concat(*parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)



M32 = 4294967296


def int_uniform(key: ColLike, salt: int) -> Column:
    """Cheap deterministic uniform in [0, 1) from a non-negative integer key.

    Integer multiply / xor-shift mixing kept below 2^63 at every step, so it
    is exact in 64-bit arithmetic in any engine and stays in codegen (no
    strings).  ``key`` must be < 2^31.
    """
    k = col(key).cast("bigint")
    x = (k * F.lit(2654435761) + F.lit(salt * 40503 + 12345)) % F.lit(M32)
    x = (x * F.lit(1597334677)) % F.lit(M32)
    x = x.bitwiseXOR(F.shiftright(x, 13))
    x = (x * F.lit(1274126177)) % F.lit(M32)
    x = x.bitwiseXOR(F.shiftright(x, 16))
    return x / F.lit(float(M32))


# ---------------------------------------------------------------- strings --

def ascii_only(c: ColLike) -> Column:
    """Remove every non-ASCII character (H1)."""
    return F.regexp_replace(col(c), r"[^\x00-\x7F]", "")


STRIP = r"^[\x09-\x0D\x1C-\x20]+|[\x09-\x0D\x1C-\x20]+$"


def strip(c: ColLike) -> Column:
    """Without the white space at both ends, line breaks and tabs included."""
    return F.regexp_replace(col(c), STRIP, "")


def clean_state(c: ColLike) -> Column:
    """State clean (B3): non-ASCII removed, one pass of '  '->' ', trimmed."""
    return strip(F.replace(ascii_only(c), F.lit("  "), F.lit(" ")))


def is_sentinel(c: ColLike, sentinels: Iterable[str] = LOCALITY_SENTINELS,
                min_len: int = 5) -> Column:
    """True when text is null, a sentinel (case-insensitive, trimmed) or too short.

    ``usable = NOT is_sentinel`` means: not null, lower(trim) not in the
    sentinel list and length(trim) > min_len.
    """
    t = F.trim(col(c))
    return ~F.coalesce(~F.lower(t).isin(*sentinels) & (F.length(t) > min_len),
                       F.lit(False))


def concat_nonnull(*cols: ColLike, sep: str = ", ") -> Column:
    """', '.join of the non-null parts (H2); null when every part is null."""
    s = F.concat_ws(sep, *[col(c) for c in cols])
    return F.when(F.length(s) > 0, s)


def concat_known(*cols: ColLike, sep: str = ", ") -> Column:
    """Like :func:`concat_nonnull` but also skips parts equal to 'unknown'."""
    parts = [F.when(F.lower(F.trim(col(c))) != "unknown", col(c)) for c in cols]
    return concat_nonnull(*parts, sep=sep)


def first_clean_line(c: ColLike, min_len: int = 2) -> Column:
    """First usable line of a free-text answer (H3).

    Lines are split on '\\n' and trimmed; a line is usable when it does not
    start with one of the skip prefixes and is longer than ``min_len``.
    Fallback: the last line longer than ``min_len``; else null.
    """
    lines = F.transform(F.split(strip(c), "\n"), strip)
    def ok(x: Column) -> Column:
        cond = F.length(x) > min_len
        for p in ANSWER_SKIP_PREFIXES:
            cond = cond & ~x.startswith(p)
        return cond
    good = F.filter(lines, ok)
    long_ = F.filter(lines, lambda x: F.length(x) > min_len)
    return F.coalesce(F.try_element_at(good, F.lit(1)),
                      F.try_element_at(long_, F.lit(-1)))


# ------------------------------------------------------------------ dates --

# Shape pre-checks for each parse format: every text the format can parse
# matches its pattern, so a failed match skips the (exception-driven, slow)
# parser without changing results.
_D = r"\d{4,}-\d{1,2}-\d{1,2}"
_M = r"\d{1,2}:\d{1,2}"
# digits of a second beyond the sixth, and what follows a time: Z, +hh, +hhmm or +hh:mm
_LONG_FRACTION = r"(\.\d{6})\d+"
_ZONE = rf"([T ]{_M}(?::\d{{1,2}}(?:\.\d{{1,6}})?)?)(?:Z|[+-]\d{{2}}(?::?\d{{2}})?)$"
_FULL_FORMATS = (
    (rf"^{_D}T{_M}:\d{{1,2}}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (rf"^{_D}T{_M}$", "yyyy-MM-dd'T'HH:mm"),
    (rf"^{_D}T{_M}:\d{{1,2}}\.\d{{1,6}}$", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    (rf"^{_D} {_M}:\d{{1,2}}$", "yyyy-MM-dd HH:mm:ss"),
    (rf"^{_D} {_M}$", "yyyy-MM-dd HH:mm"),
    (rf"^{_D} {_M}:\d{{1,2}}\.\d{{1,6}}$", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    (rf"^{_D}$", "yyyy-MM-dd"),
)
_VERBATIM_FORMATS = (
    (r"^\d{4,} [A-Za-z]{3} \d{1,2}$", "yyyy MMM dd"),
    (rf"^{_D}$", "yyyy-MM-dd"),
    (r"^\d{4,}/\d{1,2}/\d{1,2}$", "yyyy/MM/dd"),
)


def _guarded_parse(t: Column, formats) -> Column:
    return F.coalesce(*[F.when(t.rlike(rx), F.try_to_timestamp(t, F.lit(fmt))) for rx, fmt in formats])


def full_date_text(c: ColLike) -> Column:
    """Parse 'yyyy-MM-dd[(T| )HH:mm[:ss[.fraction]][zone]]' texts; anything shorter is null.

    The time stays as written on the spot: a zone (Z, +hh, +hhmm, +hh:mm) is
    read and left out, as day, season and climate cell follow the local day.
    Fractions count to the microsecond.
    """
    t = F.trim(col(c))
    t = F.regexp_replace(F.regexp_replace(t, _LONG_FRACTION, "$1"), _ZONE, "$1")
    # bound once in a lambda; written out, the formats would repeat the text's expression in the generated code
    parsed = F.transform(F.array(t), lambda x: F.when(F.length(x) >= 10, _guarded_parse(x, _FULL_FORMATS)))
    return F.element_at(parsed, 1)


def ymd_timestamp(y: ColLike, m: ColLike, d: ColLike) -> Column:
    """Timestamp from numeric year/month/day; invalid combination -> null."""
    return F.try_make_timestamp(col(y).cast("int"), col(m).cast("int"),
                                col(d).cast("int"), F.lit(0), F.lit(0), F.lit(0))


def day_of_year_date(y: ColLike, doy: ColLike) -> Column:
    """Jan 1 of ``y`` plus ``doy - 1`` days (H5); rolls over past Dec 31."""
    jan1 = F.try_make_timestamp(col(y).cast("int"), F.lit(1), F.lit(1),
                                F.lit(0), F.lit(0), F.lit(0))
    return F.when(col(doy).isNotNull(),
                  F.timestamp_add("DAY", col(doy).cast("int") - 1, jan1))


def verbatim_date(c: ColLike) -> Column:
    """Verbatim date texts: 'yyyy MMM dd', 'yyyy-MM-dd', 'yyyy/MM/dd'."""
    return _guarded_parse(F.trim(col(c)), _VERBATIM_FORMATS)


def multi_source_datetime(event_date: ColLike | None = "eventDate",
                          year: ColLike | None = "year",
                          month: ColLike | None = "month",
                          day: ColLike | None = "day",
                          start_doy: ColLike | None = "startDayOfYear",
                          verbatim: ColLike | None = "verbatimEventDate",
                          identified: ColLike | None = "dateIdentified") -> Column:
    """Date cascade (H4): first source that parses wins, row by row."""
    srcs = []
    if event_date is not None:
        srcs.append(full_date_text(event_date))
    if year is not None and month is not None and day is not None:
        srcs.append(F.when(col(year).isNotNull() & col(month).isNotNull()
                           & col(day).isNotNull(), ymd_timestamp(year, month, day)))
    if year is not None and start_doy is not None:
        srcs.append(day_of_year_date(year, start_doy))
    if verbatim is not None:
        srcs.append(verbatim_date(verbatim))
    if identified is not None:
        srcs.append(full_date_text(identified))
    return F.coalesce(*srcs)


def safe_datetime(c: ColLike) -> Column:
    """Mixed-format safe parse (H8): full ISO texts, then verbatim formats."""
    return F.coalesce(full_date_text(c), verbatim_date(c))


def season_num(month: ColLike, mode: str = "meteorological") -> Column:
    """Season code from month (H7).

    meteorological: Dec-Feb 0, Mar-May 1, Jun-Aug 2, Sep-Nov 3; null month or
    month outside 1..12 -> null.  quarter: 1..4 by calendar quarter.
    """
    m = col(month).cast("int")
    valid = m.between(1, 12)
    if mode == "quarter":
        return F.when(valid, F.floor((m - 1) / 3).cast("int") + 1)
    return F.when(valid, F.floor(F.pmod(m, F.lit(12)) / 3).cast("int"))


def _season_label(month: ColLike, labels: tuple[str, ...]) -> Column:
    code = season_num(month)
    out = F.when(code == 0, F.lit(labels[0]))
    for i in range(1, 4):
        out = out.when(code == i, F.lit(labels[i]))
    return out


def season_name(month: ColLike) -> Column:
    return _season_label(month, SEASON_NAMES)


def season_abbrev(month: ColLike) -> Column:
    return _season_label(month, SEASON_ORDER)


def random_date(lo: ColLike, hi: ColLike, u: Column) -> Column:
    """lo + floor(u * (days(hi - lo) + 1)) days, as DATE (H9)."""
    span = F.datediff(col(hi), col(lo))
    return F.date_add(col(lo), F.floor(u * (span + 1)).cast("int"))


# ---------------------------------------------------------------- geometry --

def haversine_km(lat1: ColLike, lon1: ColLike, lat2: ColLike, lon2: ColLike,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dp = p2 - p1
    dl = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(a))


def cell_area_m2(lat: ColLike, dlat_deg: float, dlon_deg: float) -> Column:
    """Area of a lat/lon cell: (R*dphi) * (R*dlambda*cos(phi))."""
    dy = EARTH_RADIUS_M * F.radians(F.lit(dlat_deg))
    dx = F.lit(EARTH_RADIUS_M) * F.radians(F.lit(dlon_deg)) * F.cos(F.radians(col(lat)))
    return F.abs(dy * dx)


# ------------------------------------------------------------------- units --

def kelvin_to_c(c: ColLike) -> Column:
    return col(c) - 273.15


def kelvin_to_f(c: ColLike) -> Column:
    return (col(c) - 273.15) * 9.0 / 5.0 + 32.0


def metres_to_mm(c: ColLike, factor: float = 1000.0) -> Column:
    return col(c) * factor


def mm_to_inch(c: ColLike) -> Column:
    return col(c) / 25.4


def fraction_to_percent(c: ColLike, factor: float = 100.0) -> Column:
    return col(c) * factor


def ms_to_mph(c: ColLike) -> Column:
    return col(c) * MS_TO_MPH


def metres_to_feet(c: ColLike) -> Column:
    return col(c) * M_TO_FT


# -------------------------------------------------------------------- json --

SOIL_SCHEMA = ("struct<properties:struct<layers:array<struct<name:string,"
               "depths:array<struct<values:struct<mean:double>>>>>>>")


def soil_ph(body: ColLike) -> Column:
    """pH from a soil payload.

    First layer named 'phh2o', its first depth, ``values.mean``; pH is
    ``round(mean / 10, 2)``.  Malformed or missing -> null.
    """
    parsed = F.from_json(col(body), SOIL_SCHEMA)
    layers = F.filter(parsed["properties"]["layers"], lambda l: l["name"] == "phh2o")
    depth = F.try_element_at(F.try_element_at(layers, F.lit(1))["depths"], F.lit(1))
    return F.round(depth["values"]["mean"] / 10.0, 2)


def elevation_from_json(body: ColLike) -> Column:
    """``results[0].elevation`` of an elevation payload."""
    return F.get_json_object(col(body), "$.results[0].elevation").cast("double")


# ------------------------------------------------------------------ report --

def popup_text(lat: ColLike, lon: ColLike, prob: ColLike) -> Column:
    """Marker popup text: probability as percent (2 dp), coords 4 dp."""
    return F.format_string("Probability: %.2f%%<br>Lat: %.4f<br>Lon: %.4f",
                           col(prob) * 100.0, col(lat), col(lon))


def marker_json(lat: ColLike, lon: ColLike, prob: ColLike) -> Column:
    """GeoJSON-like point feature (H16) as a JSON string."""
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(col(lon), col(lat)).alias("coordinates")).alias("geometry"),
        F.struct(col(prob).alias("probability"),
                 popup_text(lat, lon, prob).alias("popup")).alias("properties")))


def nan_to_null(c: ColLike) -> Column:
    """NaN -> NULL (T15); keeps NULL."""
    return F.nanvl(col(c), F.lit(None).cast("double"))
