"""Sampling / distance queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators import clean as C
from habiflow.operators import sampling as SM
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import U, with_
from habiflow.plans.registry import query

OCC = FX.OCC_SQL
D5 = math.degrees(5.0 / 6371.0)
D50 = math.degrees(50.0 / 6371.0)


def _hav(a_lat, a_lon, b_lat, b_lon) -> str:
    return (f"(2 * 6371.0 * asin(sqrt(pow(sin((radians({b_lat}) - radians({a_lat})) / 2), 2) + "
            f"cos(radians({a_lat})) * cos(radians({b_lat})) * pow(sin((radians({b_lon}) - radians({a_lon})) / 2), 2))))")


PRES_SQL = """
pres AS (SELECT * FROM clean WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL)"""


def presences(spark, sf_dir):
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    return c.filter(F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull())


def _within_sql(cand: str, key: str, radius: float, d: float, name: str) -> str:
    """Candidate keys with a presence closer than ``radius`` km (range join)."""
    return f"""
{name}_refs AS (SELECT DISTINCT decimalLatitude AS rlat, decimalLongitude AS rlon FROM pres),
{name} AS (
  SELECT DISTINCT c.{key} AS k FROM {cand} c JOIN {name}_refs r
    ON r.rlat BETWEEN c.decimalLatitude - {d} AND c.decimalLatitude + {d}
   AND r.rlon BETWEEN c.decimalLongitude - 2.0 AND c.decimalLongitude + 2.0
  WHERE {_hav('c.decimalLatitude', 'c.decimalLongitude', 'r.rlat', 'r.rlon')} < {radius}
)"""


@query("join_buffer_anti", with_(OCC, S.clean_ctes(), PRES_SQL, """
cand AS (SELECT ord, decimalLatitude, decimalLongitude FROM occ
         WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL)""",
                                  _within_sql("cand", "ord", 5.0, 1.5 * D5, "near")) + """
SELECT ord, decimalLatitude, decimalLongitude FROM cand WHERE ord NOT IN (SELECT k FROM near)""")
def q_join_buffer_anti(spark, sf_dir):
    """Raw points at least 5 km from every cleaned presence
    (grid-bucket range join + haversine, left anti)."""
    cand = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude").filter(
        F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull())
    return SM.exclude_within(cand, presences(spark, sf_dir), 5.0)


@query("join_nearest_distance", with_(OCC, S.clean_ctes(), PRES_SQL, """
cand AS (SELECT ord, decimalLatitude, decimalLongitude FROM occ
         WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL)""", f"""
refs AS (SELECT DISTINCT decimalLatitude AS rlat, decimalLongitude AS rlon FROM pres),
d AS (
  SELECT c.ord, min({_hav('c.decimalLatitude', 'c.decimalLongitude', 'r.rlat', 'r.rlon')}) AS dmin
  FROM cand c JOIN refs r
    ON r.rlat BETWEEN c.decimalLatitude - {1.5 * D50} AND c.decimalLatitude + {1.5 * D50}
   AND r.rlon BETWEEN c.decimalLongitude - 2.0 AND c.decimalLongitude + 2.0
  GROUP BY c.ord
)""") + """
SELECT c.ord, round(CASE WHEN d.dmin < 50.0 THEN d.dmin END, 6) AS nearest_km
FROM cand c LEFT JOIN d USING (ord)""")
def q_join_nearest_distance(spark, sf_dir):
    """C7 (distance form): distance to the nearest presence within 50 km, else null."""
    cand = FX.occ(spark, sf_dir).select("ord", "decimalLatitude", "decimalLongitude").filter(
        F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull())
    d = SM.nearest_distance(cand, presences(spark, sf_dir), "ord", 50.0)
    return d.select("ord", F.round("nearest_km", 6).alias("nearest_km"))


def _pseudo_sql() -> str:
    ext = """
ext AS (SELECT min(decimalLatitude) AS lat_min, max(decimalLatitude) AS lat_max,
               min(decimalLongitude) AS lon_min, max(decimalLongitude) AS lon_max,
               CAST(min(datetime) AS DATE) AS d_min, CAST(max(datetime) AS DATE) AS d_max,
               count(*) AS n FROM pres)"""
    att = f"""
att AS (
  SELECT a.range AS attempt,
         lat_min + (lat_max - lat_min) * {U('plat', 'a.range')} AS decimalLatitude,
         lon_min + (lon_max - lon_min) * {U('plon', 'a.range')} AS decimalLongitude,
         d_min + CAST(floor({U('pdate', 'a.range')} * (datediff('day', d_min, d_max) + 1)) AS INTEGER) AS absence_date
  FROM ext, range(0, (SELECT 20 * CAST(floor(n * 3.0) AS BIGINT) FROM ext)) a
)"""
    return with_(OCC, S.clean_ctes(), PRES_SQL, ext, att, _within_sql("att", "attempt", 5.0, 1.5 * D5, "near"))


PSEUDO_SELECT = """
SELECT attempt, decimalLatitude, decimalLongitude, CAST(absence_date AS TIMESTAMP) AS datetime,
       CAST(year(absence_date) AS DOUBLE) AS year, CAST(month(absence_date) AS DOUBLE) AS month,
       CAST(day(absence_date) AS DOUBLE) AS day, 0 AS occurrence
FROM att WHERE attempt NOT IN (SELECT k FROM near)
QUALIFY row_number() OVER (ORDER BY attempt) <= (SELECT CAST(floor(n * 3.0) AS BIGINT) FROM ext)"""


@query("ml_pseudo_absence", _pseudo_sql() + PSEUDO_SELECT)
def q_ml_pseudo_absence(spark, sf_dir):
    """K2: 3 background points per presence, >= 5 km from all presences,
    uniform in the presence box and date range; first accepted attempts win."""
    return SM.pseudo_absences(presences(spark, sf_dir))


@query("set_union_labeled", _pseudo_sql() + f"""
SELECT occurrence, {S.season('month')} AS season_num, count(*) AS n, count(gbifID) AS with_id FROM (
  SELECT gbifID, month, 1 AS occurrence FROM pres
  UNION ALL SELECT NULL, month, 0 FROM ({PSEUDO_SELECT}))
GROUP BY 1, 2""")
def q_set_union_labeled(spark, sf_dir):
    """G1 + T1/T2: presences (label 1) and pseudo-absences (label 0) unioned
    by name; missing columns null; season derived after the union."""
    p = presences(spark, sf_dir).select("gbifID", "decimalLatitude", "decimalLongitude", "datetime",
                                        "year", "month", "day")
    a = SM.pseudo_absences(presences(spark, sf_dir)).drop("attempt", "occurrence")
    u = SM.label_and_union(p, a)
    return u.groupBy("occurrence", "season_num").agg(F.count(F.lit(1)).alias("n"),
                                                     F.count("gbifID").alias("with_id"))


@query("win_stratified_folds", """
SELECT d.doc_id, l.quality AS label,
       CAST((row_number() OVER (PARTITION BY l.quality ORDER BY """ + U("fold", "d.doc_id") + """, d.doc_id) - 1) % 5
            AS INTEGER) AS fold
FROM labels l JOIN documents d USING (doc_id)""")
def q_win_stratified_folds(spark, sf_dir):
    """Stratified 5-fold assignment (labels joined to documents)."""
    d = FX.read(spark, sf_dir, "documents").select("doc_id")
    lab = FX.read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return SM.stratified_folds(lab.join(d, "doc_id"), "label", "doc_id").select("doc_id", "label", "fold")


@query("win_train_test_split", with_(FX.SCORED_SQL) + f"""
SELECT ord, row_number() OVER (ORDER BY {U('split', 'ord')}, ord) - 1
              < ceil(count(*) OVER () * 0.2 - 1e-9) AS is_test
FROM scored""")
def q_win_train_test_split(spark, sf_dir):
    """Exact-size 80/20 split in md5 order."""
    s = FX.scored(spark, sf_dir).select("ord")
    return SM.train_test_split(s, "ord", 0.2).select("ord", "is_test")


@query("agg_split_sizes", with_(FX.SCORED_SQL) + f"""
SELECT is_test, count(*) AS n FROM (
  SELECT row_number() OVER (ORDER BY {U('split', 'ord')}, ord) - 1 < ceil(count(*) OVER () * 0.2 - 1e-9) AS is_test
  FROM scored) GROUP BY is_test""")
def q_agg_split_sizes(spark, sf_dir):
    """Sizes of the two parts (test = ceil(0.2 n))."""
    s = SM.train_test_split(FX.scored(spark, sf_dir).select("ord"), "ord", 0.2)
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query("win_hash_shuffle", with_(OCC) + f"""
SELECT ord, row_number() OVER (ORDER BY {U('42', 'ord')}, ord) - 1 AS shuffle_pos FROM occ""")
def q_win_hash_shuffle(spark, sf_dir):
    """Reproducible shuffle positions (md5 of seed and key)."""
    return SM.hash_shuffle(FX.occ(spark, sf_dir).select("ord"), "ord", 42).select("ord", "shuffle_pos")


@query("fn_random_date", with_(OCC) + f"""
SELECT ord, CAST(DATE '1979-01-01' + CAST(floor({U('rd', 'ord')} * (datediff('day', DATE '1979-01-01',
       DATE '2020-12-31') + 1)) AS INTEGER) AS DATE) AS rdate,
       strftime(CAST(DATE '1979-01-01' + CAST(floor({U('rd', 'ord')} * (datediff('day', DATE '1979-01-01',
       DATE '2020-12-31') + 1)) AS INTEGER) AS DATE), '%Y-%m-%d') AS rdate_text
FROM occ""")
def q_fn_random_date(spark, sf_dir):
    """H9: uniform date in an inclusive range, and its yyyy-MM-dd text."""
    o = FX.occ(spark, sf_dir).select("ord")
    d = H.random_date(F.lit("1979-01-01").cast("date"), F.lit("2020-12-31").cast("date"), H.uniform("rd", "ord"))
    return o.select("ord", d.alias("rdate"), F.date_format(d, "yyyy-MM-dd").alias("rdate_text"))
