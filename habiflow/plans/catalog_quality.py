"""Profiling / validation / fingerprint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators import clean as C
from habiflow.operators import quality as Q
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import with_
from habiflow.plans.registry import query

OCC = FX.OCC_SQL


@query("agg_value_counts", with_(OCC, S.clean_ctes(time_filter=False)) + """
SELECT field, value, count(*) AS n FROM (
  SELECT 'continent' AS field, continent AS value FROM clean
  UNION ALL SELECT 'locality', locality FROM clean
  UNION ALL SELECT 'season_num', CAST(season_num AS VARCHAR) FROM clean
  UNION ALL SELECT 'occurrence', CAST(occurrence AS VARCHAR) FROM clean)
WHERE value IS NOT NULL GROUP BY field, value""")
def q_agg_value_counts(spark, sf_dir):
    """Value counts of several columns in one shuffle."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    return Q.value_counts(c, ["continent", "locality", "season_num", "occurrence"])


@query("agg_distinct_before_after", with_(OCC) + f"""
SELECT count(DISTINCT coalesce(stateProvince, 'Unknown')) AS distinct_before,
       count(DISTINCT {S.clean_state("coalesce(stateProvince, 'Unknown')")}) AS distinct_after FROM occ""")
def q_agg_distinct_before_after(spark, sf_dir):
    """Distinct states before and after cleaning."""
    o = C.fill_unknown(FX.occ(spark, sf_dir))
    return Q.distinct_before_after(o, "stateProvince", H.clean_state("stateProvince"))


_FUNNEL_STEPS_SQL = [
    ("geo_bounds", "(decimalLatitude IS NULL OR decimalLongitude IS NULL OR "
                   "(decimalLatitude BETWEEN 24 AND 71 AND decimalLongitude BETWEEN -180 AND -66))"),
    ("country", "upper(coalesce(countryCode, 'Unknown')) IN ('US', 'USA', 'UNITED STATES')"),
    ("valid_coords", "NOT (decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL AND "
                     "(decimalLatitude = 0 OR decimalLatitude > 90 OR decimalLatitude < -90 OR "
                     "decimalLongitude = 0 OR decimalLongitude > 180 OR decimalLongitude < -180))"),
    ("has_date", f"{S.DATETIME} IS NOT NULL"),
    ("has_coords", "decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL"),
]


def _funnel_sql() -> str:
    aggs = ["count(*) AS s0"]
    cond = "TRUE"
    for i, (_, p) in enumerate(_FUNNEL_STEPS_SQL, start=1):
        cond = f"{cond} AND coalesce({p}, false)"
        aggs.append(f"CAST(count_if({cond}) AS BIGINT) AS s{i}")
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step_order, '{n}' AS step, s{i - 1} AS rows_in, s{i} AS rows_out FROM w"
        for i, (n, _) in enumerate(_FUNNEL_STEPS_SQL, start=1))
    return with_(OCC, f"w AS (SELECT {', '.join(aggs)} FROM occ)") + f"""
SELECT *, round(CASE WHEN rows_in > 0 THEN rows_out * 100.0 / rows_in END, 6) AS retention_pct
FROM ({rows})"""


@query("agg_step_funnel", _funnel_sql())
def q_agg_step_funnel(spark, sf_dir):
    """D3: rows kept by each cleaning step, one pass of conditional counts."""
    o = FX.occ(spark, sf_dir)
    la, lo = F.col("decimalLatitude"), F.col("decimalLongitude")
    both = la.isNotNull() & lo.isNotNull()
    steps = [
        ("geo_bounds", ~both | (la.between(24, 71) & lo.between(-180, -66))),
        ("country", F.upper(F.coalesce(F.col("countryCode"), F.lit("Unknown"))).isin(*H.US_COUNTRY_VALUES)),
        ("valid_coords", ~(both & ((la == 0) | (la > 90) | (la < -90) | (lo == 0) | (lo > 180) | (lo < -180)))),
        ("has_date", H.multi_source_datetime().isNotNull()),
        ("has_coords", both),
    ]
    return Q.step_funnel(o, steps)


@query("agg_cleaning_summary", with_(OCC, S.clean_ctes()) + """
SELECT o.original_count, c.cleaned_count, c.year_min, c.year_max,
       o.original_count - c.cleaned_count AS removed_count,
       round(c.cleaned_count * 100.0 / o.original_count, 6) AS retention_pct,
       c.year_max - c.year_min AS year_span
FROM (SELECT count(*) AS original_count FROM occ) o,
     (SELECT count(*) AS cleaned_count, CAST(min(year) AS INTEGER) AS year_min,
             CAST(max(year) AS INTEGER) AS year_max FROM clean) c""")
def q_agg_cleaning_summary(spark, sf_dir):
    """Cleaning summary (two aggregates, 1-row cross join)."""
    o = FX.occ(spark, sf_dir)
    return Q.cleaning_summary(o, C.clean_occurrences(o))


_PROFILE_COLS = ("decimalLatitude", "decimalLongitude", "eventDate", "year", "month", "day",
                 "startDayOfYear", "verbatimEventDate", "dateIdentified", "countryCode",
                 "stateProvince", "municipality", "locality", "elevation")


@query("agg_null_profile", with_(OCC) + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM occ"
    for c in _PROFILE_COLS))
def q_agg_null_profile(spark, sf_dir):
    """Nulls per column (one aggregate pass, unpivoted)."""
    p = Q.null_profile(FX.occ(spark, sf_dir), _PROFILE_COLS)
    return p.select("column", "nulls", "non_nulls")


def _describe_sql(src: str, col: str) -> str:
    return (f"SELECT count({col}) AS count, avg({col}) AS mean, stddev_samp({col}) AS std, "
            f"CAST(min({col}) AS DOUBLE) AS min, quantile_cont({col}, 0.25) AS p25, "
            f"quantile_cont({col}, 0.5) AS p50, quantile_cont({col}, 0.75) AS p75, "
            f"CAST(max({col}) AS DOUBLE) AS max FROM {src}")


def _round_describe(df):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c not in ("count", "column") else F.col(c)
                       for c in df.columns])


def _round_describe_sql(inner: str, extra: str = "") -> str:
    return (f"SELECT {extra}count, round(mean, 6) AS mean, round(std, 6) AS std, round(min, 6) AS min, "
            f"round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(max, 6) AS max "
            f"FROM ({inner})")


@query("agg_numeric_describe", with_(OCC) + " UNION ALL ".join(
    _round_describe_sql(_describe_sql("occ", c), f"'{c}' AS column, ")
    for c in ("decimalLatitude", "decimalLongitude", "elevation")))
def q_agg_numeric_describe(spark, sf_dir):
    """describe() of numeric columns (exact quartiles, distributed)."""
    o = FX.occ(spark, sf_dir)
    return _round_describe(Q.numeric_describe(o, ["decimalLatitude", "decimalLongitude", "elevation"]))


@query("agg_describe_probability", with_(FX.SCORED_SQL) + _round_describe_sql(
    _describe_sql("scored", "probability")))
def q_agg_describe_probability(spark, sf_dir):
    """describe() of the scored probability."""
    return _round_describe(Q.describe(FX.scored(spark, sf_dir), "probability"))


def _validation_sql(src: str) -> str:
    checks = [("year_nulls", "year IS NULL"), ("year_range", "year < 1800 OR year > 2025"),
              ("month_nulls", "month IS NULL"), ("month_range", "month < 1 OR month > 12"),
              ("day_nulls", "day IS NULL"), ("day_range", "day < 1 OR day > 31"),
              ("decimalLatitude_range", "decimalLatitude < -90 OR decimalLatitude > 90"),
              ("decimalLongitude_range", "decimalLongitude < -180 OR decimalLongitude > 180")]
    aggs = ", ".join(f"CAST(count_if(coalesce({p}, false)) AS BIGINT) AS v{i}" for i, (_, p) in enumerate(checks))
    rows = [f"SELECT 1 AS ord, 'non_empty' AS rule, CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM w",
            "SELECT 2, 'expected_columns', CAST(0 AS BIGINT) FROM w",
            "SELECT 3, 'temporal_columns', CAST(0 AS BIGINT) FROM w"]
    rows += [f"SELECT {4 + i}, '{n}', v{i} FROM w" for i, (n, _) in enumerate(checks)]
    return f"w AS (SELECT count(*) AS n, {aggs} FROM {src}),\nrep AS ({' UNION ALL '.join(rows)})"


@query("agg_validation_report", with_(OCC, S.clean_ctes(time_filter=False),
                                      _validation_sql("clean")) + "SELECT * FROM rep")
def q_agg_validation_report(spark, sf_dir):
    """(ord, rule, violations) over the cleaned occurrences."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    return Q.validation_report(c, expected=["decimalLatitude", "decimalLongitude"])


@query("agg_validation_verdict", with_(OCC, S.clean_ctes(time_filter=False),
                                       _validation_sql("clean")) + """
SELECT bool_and(violations = 0) AS passed,
       arg_min(CASE WHEN violations > 0 THEN rule END, CASE WHEN violations > 0 THEN ord END) AS first_failure
FROM rep""")
def q_agg_validation_verdict(spark, sf_dir):
    """D8 verdict and first failing rule."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    return Q.validation_verdict(Q.validation_report(c, expected=["decimalLatitude", "decimalLongitude"]))


@query("agg_all_null_columns", with_(OCC, """
x AS (SELECT *, CASE WHEN gbifID < 0 THEN 'never' END AS always_null FROM occ)""") + " UNION ALL ".join(
    f"SELECT '{c}' AS column FROM x HAVING count({c}) = 0" for c in _PROFILE_COLS + ("always_null",)))
def q_agg_all_null_columns(spark, sf_dir):
    """Columns without any value (warning list)."""
    o = FX.occ(spark, sf_dir).withColumn(
        "always_null", F.when(F.col("gbifID") < 0, F.lit("never")))
    return Q.all_null_columns(o, _PROFILE_COLS + ("always_null",))


@query("agg_feature_summary", with_(OCC, S.clean_ctes(time_filter=False)) + """
SELECT 'season_num' AS column, CAST(count(*) - count(season_num) AS BIGINT) AS nulls,
       CAST(count(season_num) AS BIGINT) AS non_nulls FROM clean
UNION ALL SELECT 'decimalLatitude', count(*) - count(decimalLatitude), count(decimalLatitude) FROM clean
UNION ALL SELECT 'elevation', count(*) - count(elevation), count(elevation) FROM clean
UNION ALL SELECT 'label=' || CAST(occurrence AS VARCHAR), NULL, count(*) FROM clean GROUP BY occurrence""")
def q_agg_feature_summary(spark, sf_dir):
    """Feature null profile plus label distribution."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir), time_filter=False)
    prof = Q.null_profile(c, ["season_num", "decimalLatitude", "elevation"]).select("column", "nulls", "non_nulls")
    lab = (c.groupBy("occurrence").agg(F.count(F.lit(1)).alias("non_nulls"))
            .select(F.concat(F.lit("label="), F.col("occurrence").cast("string")).alias("column"),
                    F.lit(None).cast("bigint").alias("nulls"), "non_nulls"))
    return prof.unionByName(lab)


def _fingerprint_sql(src: str, cols: list[str]) -> str:
    txt = " || '|' || ".join(
        f"coalesce(replace(replace(CAST({c} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')" for c in cols)
    return f"""
fp_rows AS (SELECT md5({txt}) AS h FROM {src}),
fp_b AS (
  SELECT CAST(('0x' || substr(h, 1, 2)) AS INTEGER) AS b, count(*) AS n,
         sum(CAST(('0x' || substr(h, 3, 8)) AS BIGINT)) AS s
  FROM fp_rows GROUP BY 1
)"""


@query("agg_fingerprint", with_(OCC, _fingerprint_sql("occ", ["gbifID", "countryCode", "county", "locality"])) + """
SELECT CAST(sum(n) AS BIGINT) AS n_rows,
       md5(string_agg(CAST(b AS VARCHAR) || ':' || CAST(n AS VARCHAR) || ':' || CAST(CAST(s AS HUGEINT) AS VARCHAR),
                      ',' ORDER BY b)) AS fingerprint
FROM fp_b""")
def q_agg_fingerprint(spark, sf_dir):
    """Order-insensitive fingerprint of the occurrence table."""
    return Q.fingerprint(FX.occ(spark, sf_dir), ["gbifID", "countryCode", "county", "locality"])
