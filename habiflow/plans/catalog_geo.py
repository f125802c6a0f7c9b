"""Geocoding and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow import sources as SRC
from habiflow.operators import clean as C
from habiflow.operators import enrich as EN
from habiflow.operators import geocode as G
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import with_
from habiflow.plans.registry import query

OCC = FX.OCC_SQL
LA, LO = FX.LAT_AXIS, FX.LON_AXIS


def _geo_input(spark, sf_dir):
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    # landmark answers of an external extractor, derived per row for the test
    return c.withColumn("landmark", F.when(F.col("gbifID") % 9 == 4,
                                           F.concat(F.lit("Town "), (F.col("gbifID") % 40).cast("string"))))


GEO_IN_SQL = """
geo_in AS (SELECT *, CASE WHEN gbifID % 9 = 4 THEN 'Town ' || CAST(gbifID % 40 AS VARCHAR) END AS landmark FROM clean)"""


def _nn(*parts: str) -> str:
    return f"nullif(concat_ws(', ', {', '.join(parts)}), '')"


def _usable_sql(c: str, sentinels, n: int) -> str:
    lst = ", ".join(f"'{s}'" for s in sentinels)
    return f"coalesce(lower(trim({c})) NOT IN ({lst}) AND length(trim({c})) > {n}, false)"


def _known(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) <> 'unknown' THEN {c} END"


def _cands_sql(src: str = "geo_in") -> str:
    loc_ok = _usable_sql("locality", H.LOCALITY_SENTINELS, 5)
    verb_ok = _usable_sql("verbatimLocality", H.VERBATIM_SENTINELS, 5)
    verb_lm_ok = _usable_sql("verbatimLocality", H.VERBATIM_LANDMARK_SENTINELS, 5)
    mun_ok = (f"coalesce(lower(trim(municipality)) NOT IN ('nan', 'none', '') AND "
              f"length(trim(municipality)) > 2, false)")
    src_ok = f"({loc_ok} OR (locality IS NULL AND {verb_lm_ok}))"
    ctx = ", ".join(_known(c) for c in ("county", "stateProvince", "countryCode"))
    items = [
        (1, "gaz", _nn(*map(_known, ("locality", "municipality", "county", "stateProvince", "countryCode"))), "TRUE", False),
        (2, "gaz", "trim(verbatimLocality)", verb_ok, False),
        (3, "gaz", "trim(locality)", loc_ok, False),
        (4, "gaz", _nn(*map(_known, ("trim(verbatimLocality)", "county", "stateProvince"))), verb_ok, False),
        (5, "gaz", _nn(*map(_known, ("locality", "county", "stateProvince"))), "locality IS NOT NULL", False),
        (6, "gaz", _nn("landmark", ctx), f"{src_ok} AND landmark IS NOT NULL", True),
        (7, "gaz", "landmark", src_ok, True),
        (8, "gaz", "trim(municipality)", mun_ok, False),
        (9, "gaz", _nn(*map(_known, ("trim(municipality)", "county", "stateProvince", "countryCode"))), mun_ok, False),
        (12, "locality", "locality", "TRUE", False),
        (13, "municipality", "municipality", "TRUE", False),
        (14, "gaz", _nn(*map(_known, ("county", "stateProvince", "countryCode"))),
         "county IS NOT NULL AND stateProvince IS NOT NULL", False),
    ]
    sel = " UNION ALL ".join(
        f"SELECT ord AS rid, {p} AS pos, '{k}' AS kind, {str(l).upper()} AS llm, "
        f"CASE WHEN {cond} THEN {'lower(trim(' + t + '))' if k == 'gaz' else t} END AS key FROM need"
        for p, k, t, cond, l in items)
    return f"""
need AS (SELECT * FROM {src} WHERE decimalLatitude IS NULL OR decimalLongitude IS NULL),
cands AS (SELECT * FROM ({sel}) WHERE key IS NOT NULL AND length(key) > 0),
lookup AS (
  SELECT 'gaz' AS kind, lower(trim(place_key)) AS key, lat, lon FROM gazetteer
  UNION ALL SELECT kind, place, lat, lon FROM manual
),
best AS (
  SELECT rid, arg_min(lat, pos) AS blat, arg_min(lon, pos) AS blon, min(pos) AS bpos,
         arg_min(llm, pos) AS bllm
  FROM cands JOIN lookup USING (kind, key) GROUP BY rid
),
geo AS (
  SELECT g.* REPLACE (
           CASE WHEN g.decimalLatitude IS NOT NULL AND g.decimalLongitude IS NOT NULL THEN g.decimalLatitude ELSE b.blat END AS decimalLatitude,
           CASE WHEN g.decimalLatitude IS NOT NULL AND g.decimalLongitude IS NOT NULL THEN g.decimalLongitude ELSE b.blon END AS decimalLongitude),
         CASE WHEN g.decimalLatitude IS NOT NULL AND g.decimalLongitude IS NOT NULL THEN false ELSE coalesce(b.bllm, false) END AS used_llm,
         CASE WHEN NOT (g.decimalLatitude IS NOT NULL AND g.decimalLongitude IS NOT NULL) THEN b.bpos END AS geocode_pos
  FROM {src} g LEFT JOIN best b ON g.ord = b.rid
)"""


GEO_SQL = with_(OCC, S.clean_ctes(), FX.GAZETTEER_SQL, FX.MANUAL_SQL, GEO_IN_SQL, _cands_sql())


@query("join_geocode_cascade", GEO_SQL + """
SELECT ord, gbifID, decimalLatitude, decimalLongitude, used_llm, geocode_pos FROM geo""")
def q_join_geocode_cascade(spark, sf_dir):
    """Ranked candidate strings -> gazetteer equi-join -> first hit per row."""
    g = G.geocode_cascade(_geo_input(spark, sf_dir), FX.gazetteer(spark, sf_dir),
                          FX.manual_geocodes(spark, sf_dir))
    return g.select("ord", "gbifID", "decimalLatitude", "decimalLongitude", "used_llm", "geocode_pos")


@query("agg_geocode_summary", GEO_SQL + """
SELECT count(*) AS total,
       CAST(count_if(decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL) AS BIGINT) AS geocoded,
       CAST(count_if(coalesce(used_llm, false)) AS BIGINT) AS flagged,
       count(*) - CAST(count_if(decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL) AS BIGINT) AS failed,
       round(count_if(decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL) * 100.0 / count(*), 6) AS success_pct,
       round(count_if(coalesce(used_llm, false)) * 100.0 / count(*), 6) AS flagged_pct
FROM geo""")
def q_agg_geocode_summary(spark, sf_dir):
    """Geocoding summary."""
    g = G.geocode_cascade(_geo_input(spark, sf_dir), FX.gazetteer(spark, sf_dir),
                          FX.manual_geocodes(spark, sf_dir))
    return G.geocode_summary(g)


@query("join_manual_geocode", with_(OCC, S.clean_ctes(), FX.MANUAL_SQL) + """
SELECT c.ord,
  CASE WHEN c.decimalLatitude IS NULL OR c.decimalLongitude IS NULL THEN coalesce(l.lat, m.lat) ELSE c.decimalLatitude END
    AS decimalLatitude,
  CASE WHEN c.decimalLatitude IS NULL OR c.decimalLongitude IS NULL THEN coalesce(l.lon, m.lon) ELSE c.decimalLongitude END
    AS decimalLongitude
FROM clean c
LEFT JOIN (SELECT place, lat, lon FROM manual WHERE kind = 'locality') l ON c.locality = l.place
LEFT JOIN (SELECT place, lat, lon FROM manual WHERE kind = 'municipality') m ON c.municipality = m.place""")
def q_join_manual_geocode(spark, sf_dir):
    """Manual locality map, then municipality map, for rows lacking coordinates."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    return G.apply_manual(c, FX.manual_geocodes(spark, sf_dir)).select("ord", "decimalLatitude", "decimalLongitude")


def _snap_sql(src: str) -> str:
    return f"""SELECT *, {LA.sql_index('decimalLatitude')} AS ilat, {LO.sql_index('decimalLongitude')} AS ilon
FROM {src} WHERE decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL"""


def _points(spark, sf_dir):
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    return c.filter(F.col("decimalLatitude").isNotNull() & F.col("decimalLongitude").isNotNull())


@query("join_fill_elevation", with_(OCC, S.clean_ctes(), FX.ELEV_SQL, f"p AS ({_snap_sql('clean')})") + """
SELECT p.ord, coalesce(p.elevation, e.elevation) AS elevation FROM p LEFT JOIN elev e USING (ilat, ilon)""")
def q_join_fill_elevation(spark, sf_dir):
    """C3 + T13: elevation lookup only where the dump has none."""
    spec = FX.raster_spec(spark, sf_dir)
    e = EN.fill_elevation(_points(spark, sf_dir), FX.elev(spark), spec)
    return e.select("ord", "elevation")


def _soil_sql(body: str) -> str:
    return (f"round(CAST(json_extract(list_filter(CAST(json_extract({body}, '$.properties.layers') AS JSON[]), "
            f"lambda l: json_extract_string(l, '$.name') = 'phh2o')[1], '$.depths[0].values.mean') AS DOUBLE) / 10, 2)")


@query("join_fill_soil", with_(OCC, S.clean_ctes(), FX.SOIL_SQL, f"p AS ({_snap_sql('clean')})") + f"""
SELECT p.ord, {_soil_sql('s.body')} AS soil_ph FROM p LEFT JOIN soil s USING (ilat, ilon)""")
def q_join_fill_soil(spark, sf_dir):
    """C4: soil pH from the cell's JSON payload."""
    spec = FX.raster_spec(spark, sf_dir)
    s = EN.fill_soil_ph(_points(spark, sf_dir), FX.soil(spark), spec)
    return s.select("ord", "soil_ph")


@query("fn_soil_json", with_(OCC, S.clean_ctes(), FX.SOIL_SQL, f"p AS ({_snap_sql('clean')})") + f"""
SELECT p.ord, s.body IS NOT NULL AS has_payload, {_soil_sql('s.body')} AS ph
FROM p JOIN soil s USING (ilat, ilon)""")
def q_fn_soil_json(spark, sf_dir):
    """First 'phh2o' layer, first depth, mean / 10 rounded to 2."""
    spec = FX.raster_spec(spark, sf_dir)
    from habiflow.operators.raster import snap_cells
    p = snap_cells(_points(spark, sf_dir), spec)
    j = p.join(FX.soil(spark), ["ilat", "ilon"])
    return j.select("ord", F.col("body").isNotNull().alias("has_payload"), H.soil_ph("body").alias("ph"))


@query("fn_elevation_json", with_(OCC, S.clean_ctes(), FX.ELEV_SQL, f"p AS ({_snap_sql('clean')})") + """
SELECT p.ord, e.elevation AS elevation FROM p LEFT JOIN elev e USING (ilat, ilon)""")
def q_fn_elevation_json(spark, sf_dir):
    """``results[0].elevation`` of elevation-service payloads built per point."""
    spec = FX.raster_spec(spark, sf_dir)
    from habiflow.operators.raster import snap_cells
    p = snap_cells(_points(spark, sf_dir).drop("elevation"), spec).join(FX.elev(spark), ["ilat", "ilon"], "left")
    docs = EN.elevation_payloads(p, "ord")
    return docs.select("ord", H.elevation_from_json("body").alias("elevation"))


@query("src_json_map_explode", """
WITH docs AS (
  SELECT c_custkey,
    round(30 + 15 * """ + FX.U('jla', 'c_custkey') + """, 6) AS a_lat, round(-120 + 40 * """ + FX.U('jlo', 'c_custkey') + """, 6) AS a_lon,
    round(30 + 15 * """ + FX.U('jlb', 'c_custkey') + """, 6) AS b_lat, round(-120 + 40 * """ + FX.U('jlp', 'c_custkey') + """, 6) AS b_lon
  FROM customer)
SELECT 'Site ' || CAST(c_custkey AS VARCHAR) AS place, a_lat AS lat, a_lon AS lon FROM docs
UNION ALL SELECT 'Trailhead ' || CAST(c_custkey AS VARCHAR), b_lat, b_lon FROM docs""")
def q_src_json_map_explode(spark, sf_dir):
    """JSON map documents {place: {lat, lon}} exploded to rows."""
    return SRC.manual_geocode_map(FX.manual_json(spark, sf_dir))


_LISTS_SQL = """
arr AS (SELECT ord, [decimalLatitude, decimalLongitude, round(decimalLatitude + 0.5, 6), round(decimalLongitude - 0.5, 6)]
               || CASE WHEN ord % 2 = 0 THEN [round(decimalLatitude - 0.25, 6)] ELSE [] END AS coords FROM scored)"""


def _lists(spark, sf_dir):
    """A flat coordinate list a row; every second one has an odd length."""
    s = FX.scored(spark, sf_dir)
    arr = F.concat(F.array("decimalLatitude", "decimalLongitude",
                           F.round(F.col("decimalLatitude") + 0.5, 6), F.round(F.col("decimalLongitude") - 0.5, 6)),
                   F.when(F.col("ord") % 2 == 0, F.array(F.round(F.col("decimalLatitude") - 0.25, 6)))
                    .otherwise(F.array().cast("array<double>")))
    return s.select("ord", arr.alias("coords"))


@query("src_points_from_array", with_(FX.SCORED_SQL, _LISTS_SQL) + """
SELECT ord, CAST(i AS INTEGER) AS point_idx, coords[2 * i + 1] AS lat, coords[2 * i + 2] AS lon
FROM (SELECT ord, CASE WHEN ord % 2 = 0 THEN coords[1:4] ELSE coords END AS coords FROM arr),
     range(0, CAST(len(coords) / 2 AS BIGINT)) t(i)""")
def q_src_points_from_array(spark, sf_dir):
    """Flat coordinate lists -> points; lists of odd length are an error, so theirs are repaired first."""
    a = _lists(spark, sf_dir)
    whole = a.withColumn("coords", F.slice("coords", 1, F.when(F.col("ord") % 2 == 0, 4).otherwise(F.size("coords"))))
    return SRC.points_from_array(whole, "coords", "ord")


@query("src_odd_lists", with_(FX.SCORED_SQL, _LISTS_SQL) + """
SELECT ord, CAST(len(coords) AS INTEGER) AS n FROM arr WHERE len(coords) % 2 = 1""")
def q_src_odd_lists(spark, sf_dir):
    """The lists that :func:`habiflow.sources.points_from_array` refuses."""
    return SRC.odd_length_rows(_lists(spark, sf_dir), "coords").select("ord", F.size("coords").alias("n"))


@query("src_bbox_grid", with_(OCC, S.clean_ctes(), """
b AS (SELECT min(decimalLatitude) AS la0, max(decimalLatitude) AS la1,
             min(decimalLongitude) AS lo0, max(decimalLongitude) AS lo1 FROM clean
      WHERE decimalLatitude BETWEEN 42.0 AND 49.0 AND decimalLongitude BETWEEN -117.24 AND -111.04)""") + """
SELECT i, j, la0 + i * 0.05 AS lat, lo0 + j * 0.05 AS lon
FROM b, range(0, CAST(ceil((la1 - la0) / 0.05) AS BIGINT)) a(i), range(0, CAST(ceil((lo1 - lo0) / 0.05) AS BIGINT)) c(j)""")
def q_src_bbox_grid(spark, sf_dir):
    """0.05-degree prediction grid over the box spanned by the cleaned
    points inside the Idaho window (half-open arange semantics)."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    b = C.filter_bbox(c, 42.0, 49.0, -117.24, -111.04).agg(
        F.min("decimalLatitude").alias("la0"), F.max("decimalLatitude").alias("la1"),
        F.min("decimalLongitude").alias("lo0"), F.max("decimalLongitude").alias("lo1")).collect()[0]
    return SRC.bbox_grid(spark, b["la0"], b["la1"], b["lo0"], b["lo1"], 0.05)


@query("sink_resume_anti_join", with_(OCC, S.clean_ctes()) + """
SELECT ord, gbifID FROM clean c
WHERE decimalLatitude IS NOT NULL
  AND gbifID NOT IN (SELECT gbifID FROM clean WHERE elevation IS NOT NULL AND gbifID IS NOT NULL)""")
def q_sink_resume_anti_join(spark, sf_dir):
    """Rows still to enrich = todo minus rows already in the output
    (here: rows that already carry an elevation), by key."""
    c = C.clean_occurrences(FX.occ(spark, sf_dir))
    todo = c.filter(F.col("decimalLatitude").isNotNull()).select("ord", "gbifID")
    done = c.filter(F.col("elevation").isNotNull()).select("gbifID")
    return SRC.resume_pending(todo, done, ["gbifID"])
