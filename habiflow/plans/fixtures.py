"""Test inputs derived from the driver's tables, in Spark and in DuckDB SQL.

Every table here is a pure function of the driver parquet files, so its size
grows with the scale factor.  The same derivation is written twice: once as
DataFrame code (what the queries run) and once as DuckDB SQL text (what the
oracle runs).  Randomness is the md5 uniform ``u(salt, key)`` (per-row tables) or
the integer-mix uniform ``int_uniform`` (the raster cube), so both
engines produce identical values.

Tables
------
occ        occurrence-like rows (GBIF column names) from ``events``
           (+ a copy of every event with event_id % 50 = 7, for keep-first dedup)
raster     climate cube: one weekly time step per ``customer`` row x a fixed
           12 x 29 grid of 2-degree cells, 8 variables (nulls and NaNs included)
elev       elevation per grid cell;  soil: JSON soil payload per grid cell
gazetteer  place key -> lat/lon (customer-driven 'site n' keys + towns/counties)
manual     manual geocodes (locality / municipality maps) from ``customer``
scored     occ rows with coordinates + probability/prediction/label
importance (model, feature, importance) from ``part``
runs       run metadata from ``orders``
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators.raster import Axis, RasterSpec

# ---------------------------------------------------------------- spec ----
# Grid geometry of the fixture cube (parameters, not data).
LAT_AXIS = Axis("lat", origin=49.0, step=-2.0, size=12)
LON_AXIS = Axis("lon", origin=-124.5, step=2.0, size=29)
TIME_ORIGIN = "1979-01-01"
TIME_STEP_DAYS = 7
CLIMATE_VARS = ("air_temperature", "precipitation_amount", "specific_humidity",
                "relative_humidity", "mean_vapor_pressure_deficit",
                "potential_evapotranspiration",
                "surface_downwelling_shortwave_flux_in_air", "wind_speed")
# Times of day behind a date text.
TIMES = ("T08:30", "T08:30:15.250", "T08:30:15Z", "T23:30:00+02:00", " 10:30")
# (base, span) of each variable's uniform draw.
VAR_RANGES = ((270.0, 40.0), (0.0, 10.0), (0.0, 0.02), (5.0, 95.0),
              (0.0, 3.0), (0.0, 12.0), (50.0, 320.0), (0.5, 11.0))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _source_tag(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], version: str) -> str:
    import hashlib
    parts = [sf_dir.rstrip("/"), version]
    for t in tables:
        p, fs = _fs(spark, os.path.join(sf_dir, f"{t}.parquet"))
        try:
            st = fs.getFileStatus(p)
            parts.append(f"{t}:{st.getLen()}:{st.getModificationTime()}")
        except Exception:  # noqa: BLE001
            parts.append(f"{t}:missing")
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:16]


def materialize(spark: SparkSession, name: str, sf_dir: str, tables: tuple[str, ...], build,
                partition_by: str | None = None, version: str = "v3") -> DataFrame:
    """Write a derived input table once per input folder under the shared
    checkpoint folder and read it back.

    Written to a unique temporary folder and renamed into place, so
    concurrent or interrupted runs never leave a half-written table behind
    (a rerun simply rebuilds it).  Works on any Hadoop file system.
    """
    import uuid
    from habiflow.session import stage_path
    path = stage_path(spark, f"{name}_{_source_tag(spark, sf_dir, tables, version)}")
    p, fs = _fs(spark, path)
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not fs.exists(done):
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(tmp)
        tp, _ = _fs(spark, tmp)
        if not fs.exists(done):
            if fs.exists(p):
                fs.delete(p, True)
            fs.rename(tp, p)
        else:
            fs.delete(tp, True)
    return spark.read.parquet(path)


_SPEC_SIZES: dict = {}


def raster_spec(spark: SparkSession, sf_dir: str) -> RasterSpec:
    """Raster description; the time axis length is the customer count.

    The count comes from parquet footers (metadata only, no scan)."""
    key = (sf_dir.rstrip("/"), _source_tag(spark, sf_dir, ("customer",), "spec"))
    n_time = _SPEC_SIZES.get(key)
    if n_time is None:
        n_time = _SPEC_SIZES[key] = read(spark, sf_dir, "customer").count()
    return RasterSpec(lat=LAT_AXIS, lon=LON_AXIS, time_origin=TIME_ORIGIN,
                      time_step_days=TIME_STEP_DAYS, time_size=n_time,
                      variables=CLIMATE_VARS, time_block=TIME_BLOCK)


# --------------------------------------------------------------- spark ----

def occ(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrence table derived from ``events`` (written once, read back, so
    filters reach the Parquet scan as they would on a real dump)."""
    cols = ["ord", "gbifID", "decimalLatitude", "decimalLongitude", "eventDate", "year", "month", "day",
            "startDayOfYear", "verbatimEventDate", "dateIdentified", "countryCode", "stateProvince",
            "county", "municipality", "locality", "verbatimLocality", "continent", "basisOfRecord",
            "elevation"]
    return materialize(spark, "occ", sf_dir, ("events",), lambda: occ_generated(spark, sf_dir),
                       version="v5").select(*cols)


def occ_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    src = ev.withColumn("ord", F.col("event_id")).unionByName(
        ev.filter(F.col("event_id") % 50 == 7)
          .withColumn("ord", F.col("event_id") + F.lit(1_000_000_000)))
    i = F.col("event_id")
    m6, m5 = i % 6, i % 5
    obs = F.date_sub(F.to_date("ts"), F.floor(18000 * H.uniform("day", i)).cast("int"))
    b = src.withColumn("obs", obs)
    no_xy = i % 10 == 3
    zero = i % 97 == 0
    lat = (F.when(no_xy, F.lit(None).cast("double")).when(zero, F.lit(0.0))
           .otherwise(20 + 35 * H.uniform("lat", i)))
    lon = (F.when(no_xy, F.lit(None).cast("double")).when(zero, F.lit(0.0))
           .otherwise(-130 + 70 * H.uniform("lon", i)))
    o = F.col("obs")
    ev_date = (F.when(m6 == 0, F.date_format(o, "yyyy-MM-dd"))
               .when(m6 == 1, F.concat(F.date_format(o, "yyyy-MM-dd"),
                                       F.element_at(F.array(*[F.lit(t) for t in TIMES]), (m5 + 1).cast("int"))))
               .when(m6 == 2, F.concat(F.date_format(o, "yyyy-MM"), F.lit("/"),
                                       F.date_format(o, "yyyy-MM"))))
    ymd = m6.isin(2, 3)
    et = F.col("event_type")
    return b.select(
        F.col("ord"),
        i.alias("gbifID"),
        lat.alias("decimalLatitude"),
        lon.alias("decimalLongitude"),
        ev_date.alias("eventDate"),
        F.when(ymd | (m6 == 4), F.year(o).cast("double")).alias("year"),
        F.when(ymd, F.month(o).cast("double")).alias("month"),
        F.when(ymd, F.dayofmonth(o).cast("double")).alias("day"),
        F.when(m6 == 4, F.dayofyear(o).cast("double")).alias("startDayOfYear"),
        F.when((m6 == 5) & (m5 != 0), F.date_format(o, "yyyy MMM dd")).alias("verbatimEventDate"),
        F.when((m6 == 5) & (m5 == 0), F.date_format(o, "yyyy-MM-dd")).alias("dateIdentified"),
        (F.when(et == "view", "US").when(et == "click", "us")
          .when(et == "signup", "United States").when(et == "purchase", "CA")).alias("countryCode"),
        (F.when(i % 4 == 0, "Idaho (愛達荷州)").when(i % 4 == 1, "Montana")
          .when(i % 4 == 2, " New  York ")).alias("stateProvince"),
        F.concat(F.lit("County "), (F.col("user_id") % 20).cast("string")).alias("county"),
        F.when(m5 != 0, F.concat(F.lit("Town "), (F.col("user_id") % 40).cast("string"))).alias("municipality"),
        (F.when(i % 3 == 1, "No specific locality recorded")
          .when((i % 3 == 2) & (F.col("ord") == i), F.concat(F.lit("Site "), F.col("user_id").cast("string")))
          .when(i % 3 == 2, F.concat(F.lit("Again site "), F.col("user_id").cast("string")))).alias("locality"),
        (F.when(i % 7 == 1, "Canada, British Columbia")
          .when(i % 7 == 2, "no verbatim locality recorded")
          .when(i % 7 >= 3, F.concat(F.lit("Trail near Site "), F.col("user_id").cast("string")))
         ).alias("verbatimLocality"),
        (F.when(i % 11 == 5, "ASIA").when(i % 11 != 6, "NORTH_AMERICA")).alias("continent"),
        (F.when(i % 3 == 0, "HumanObservation").when(i % 3 == 1, "PreservedSpecimen")
          .otherwise("MachineObservation")).alias("basisOfRecord"),
        # the later row of an id differs from the first
        F.when(i % 8 == 1, F.round(3000 * H.uniform("gelev", i))).when(F.col("ord") != i, F.lit(1.0)).alias("elevation"),
    )


def _staged_int_uniforms(df: DataFrame, key: str, salts: list[int]) -> DataFrame:
    """Add ``__u<salt>`` = int_uniform(key, salt) in staged projections, so
    intermediates that are used twice stay attributes instead of being
    inlined (and recomputed) by the optimizer."""
    m = F.lit(H.M32)
    k = F.col(key).cast("bigint")
    x = df.select("*", *[(((k * F.lit(2654435761) + F.lit(s * 40503 + 12345)) % m) * F.lit(1597334677) % m)
                         .alias(f"__a{s}") for s in salts])
    x = x.select(*[c for c in x.columns if not c.startswith("__a")],
                 *[F.col(f"__a{s}").bitwiseXOR(F.shiftright(F.col(f"__a{s}"), 13)).alias(f"__b{s}")
                   for s in salts])
    x = x.select(*[c for c in x.columns if not c.startswith("__b")],
                 *[((F.col(f"__b{s}") * F.lit(1274126177)) % m).alias(f"__c{s}") for s in salts])
    return x.select(*[c for c in x.columns if not c.startswith("__c")],
                    *[(F.col(f"__c{s}").bitwiseXOR(F.shiftright(F.col(f"__c{s}"), 16)) / F.lit(float(H.M32)))
                      .alias(f"__u{s}") for s in salts])


TIME_BLOCK = 52   # time steps per raster partition (about a year of weeks)
STEPS_PER_TASK = 2000   # time steps that a task derives


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The climate cube as a Parquet table partitioned by ``tblock``, the form of a real raster.

    Derived once per input folder and written under the shared checkpoint
    folder (``spark.checkpoint.dir``); later calls read it back.  Reading
    Parquet gives the planner true sizes and lets joins prune partitions by
    the points' time blocks.
    """
    cols = ["itime", "ilat", "ilon", "time", "lat", "lon", *CLIMATE_VARS, "tblock"]
    def build():
        return (raster_generated(spark, sf_dir).withColumn("tblock", (F.col("itime") / TIME_BLOCK).cast("int"))
                .repartition("tblock"))
    return materialize(spark, "raster", sf_dir, ("customer",), build, partition_by="tblock").select(*cols)


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`raster` as the queries read them: derived while they are read.

    The cube is 348 rows for each customer, some thousand times the input's
    bytes when stored.  Tasks derive runs of time steps, so what groups by time
    step needs no shuffle, what groups by month or year combines before it, and
    filters on ``tblock`` and ``itime`` reach the customers.  The planner can't
    know the cube's size: joins must not leave their method to it.
    """
    return raster_generated(spark, sf_dir).withColumn("tblock", (F.col("itime") / TIME_BLOCK).cast("int"))


def cube_by_block(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """The rows of :func:`cube` dealt by ``block``, the time block of ``itime - shift``.

    Cubes with the same blocks lie alike, whatever the shift of each, so
    :func:`habiflow.operators.raster.align_inner` moves none of their cells.
    """
    return raster_generated(spark, sf_dir, F.floor((F.col("itime") - shift) / TIME_BLOCK).cast("int"))


def raster_generated(spark: SparkSession, sf_dir: str, block: F.Column | None = None) -> DataFrame:
    """Long-form climate cube ``(itime, ilat, ilon, time, lat, lon, vars...)``; with ``block`` dealt by that column, else by ranges."""
    t = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("itime"))
    # spread time steps over the cluster before expanding them (the customer
    # file may be a single split; a number of partitions that AQE keeps); then
    # every time step expands to the fixed 12 x 29 spatial grid by a generator,
    # which stays in codegen
    n_tasks = max(1, -(-raster_spec(spark, sf_dir).time_size // STEPS_PER_TASK))
    t = t.repartitionByRange(n_tasks, "itime") if block is None else t.withColumn("block", block).repartition(n_tasks, "block")
    n_cells = LAT_AXIS.size * LON_AXIS.size
    cube = (t.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1))).alias("cell"))
             .select(*t.columns, (F.col("cell") / LON_AXIS.size).cast("int").alias("ilat"),
                     (F.col("cell") % LON_AXIS.size).cast("int").alias("ilon")))
    cube = cube.withColumn(
        "__key", (F.col("itime").cast("bigint") * LAT_AXIS.size + F.col("ilat")) * LON_AXIS.size + F.col("ilon"))
    salts = list(range(1, len(CLIMATE_VARS) + 1))
    cube = _staged_int_uniforms(cube, "__key", salts)
    vals = []
    for k, (name, (base, span)) in enumerate(zip(CLIMATE_VARS, VAR_RANGES)):
        v = F.lit(base) + F.lit(span) * F.col(f"__u{salts[k]}")
        if name == "air_temperature":
            v = F.when((7 * F.col("ilat") + 3 * F.col("ilon") + F.col("itime")) % 41 != 0, v)
        if name == "wind_speed":
            v = F.when((F.col("ilat") + 2 * F.col("ilon") + 5 * F.col("itime")) % 37 == 0,
                       F.lit(float("nan"))).otherwise(v)
        vals.append(v.alias(name))
    return cube.select(
        "itime", "ilat", "ilon",
        F.date_add(F.lit(TIME_ORIGIN).cast("date"), F.col("itime") * TIME_STEP_DAYS).alias("time"),
        (F.lit(LAT_AXIS.origin) + F.lit(LAT_AXIS.step) * F.col("ilat")).alias("lat"),
        (F.lit(LON_AXIS.origin) + F.lit(LON_AXIS.step) * F.col("ilon")).alias("lon"),
        *vals, *[c for c in t.columns if c != "itime"])


def grid_cells(spark: SparkSession) -> DataFrame:
    la = spark.range(LAT_AXIS.size).select(F.col("id").cast("int").alias("ilat"))
    lo = spark.range(LON_AXIS.size).select(F.col("id").cast("int").alias("ilon"))
    return la.crossJoin(lo)


def elev(spark: SparkSession) -> DataFrame:
    key = F.concat_ws(":", F.col("ilat").cast("string"), F.col("ilon").cast("string"))
    return grid_cells(spark).select(
        "ilat", "ilon",
        F.when((F.col("ilat") + F.col("ilon")) % 13 != 0,
               F.round(4000 * H.uniform("elev", key))).alias("elevation"))


def soil(spark: SparkSession) -> DataFrame:
    key = F.concat_ws(":", F.col("ilat").cast("string"), F.col("ilon").cast("string"))
    n = (40 + F.floor(45 * H.uniform("soil", key))).cast("string")
    body = F.concat(
        F.lit('{"properties":{"layers":[{"name":"clay","depths":[{"values":{"mean":1}}]},'
              '{"name":"phh2o","depths":[{"values":{"mean":'), n, F.lit("}}]}]}}"))
    return grid_cells(spark).select(
        "ilat", "ilon", F.when((F.col("ilat") * F.col("ilon")) % 17 != 0, body).alias("body"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey")
    # a place for every customer, of which one in three is named by occurrences
    sites = c.select(F.concat(F.when(F.col("c_custkey") % 3 == 0, "site ").otherwise("camp "),
                              F.col("c_custkey").cast("string")).alias("place_key"))
    n = spark.range(40).select(F.col("id"))
    towns = n.filter(F.col("id") % 2 == 0).select(
        F.concat(F.lit("town "), F.col("id").cast("string")).alias("place_key"))
    counties = n.filter(F.col("id") < 20).select(
        F.concat(F.lit("county "), F.col("id").cast("string"), F.lit(", montana, us")).alias("place_key"))
    keys = sites.unionByName(towns).unionByName(counties)
    return keys.select("place_key",
                       (24 + 25 * H.uniform("glat", F.col("place_key"))).alias("lat"),
                       (-124 + 57 * H.uniform("glon", F.col("place_key"))).alias("lon"))


def manual_geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, place, lat, lon): kind 'locality' or 'municipality'."""
    c = read(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    loc = c.select(F.lit("locality").alias("kind"),
                   F.concat(F.when(k % 7 == 0, "Site ").otherwise("Hut "), k.cast("string")).alias("place"))
    mun = c.select(F.lit("municipality").alias("kind"),
                   F.concat(F.when((k < 40) & (k % 5 == 0), "Town ").otherwise("Village "), k.cast("string")).alias("place"))
    p = loc.unionByName(mun)
    return p.select("kind", "place",
                    F.round(30 + 15 * H.uniform("mlat", F.col("place")), 6).alias("lat"),
                    F.round(-120 + 40 * H.uniform("mlon", F.col("place")), 6).alias("lon"))


def manual_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON map document per customer (A7 input)."""
    c = read(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    def entry(name: str, ls: str, os_: str) -> F.Column:
        return F.concat(F.lit('"'), F.lit(name), k.cast("string"), F.lit('": {"lat": '),
                        F.round(30 + 15 * H.uniform(ls, k), 6).cast("string"),
                        F.lit(', "lon": '),
                        F.round(-120 + 40 * H.uniform(os_, k), 6).cast("string"), F.lit("}"))
    body = F.concat(F.lit("{"), entry("Site ", "jla", "jlo"), F.lit(", "),
                    entry("Trailhead ", "jlb", "jlp"), F.lit("}"))
    return c.select(k.alias("doc_id"), body.alias("body"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = occ(spark, sf_dir).filter(F.col("decimalLatitude").isNotNull())
    p = F.round(H.uniform("p", F.col("gbifID")), 2)
    return o.select("ord", "gbifID", "decimalLatitude", "decimalLongitude",
                    p.alias("probability"),
                    (p >= 0.5).cast("int").alias("prediction"),
                    (H.uniform("y", F.col("gbifID")) < p).cast("int").alias("label"))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_brand", "p_type", "p_retailprice")
    g = p.groupBy("p_brand", "p_type").agg(F.sum("p_retailprice").alias("s"))
    t = p.groupBy("p_brand").agg(F.sum("p_retailprice").alias("t"))
    return g.join(t, "p_brand").select(F.col("p_brand").alias("model"),
                                       F.col("p_type").alias("feature"),
                                       (F.col("s") / F.col("t")).alias("importance"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("version_id"),
                    F.col("o_orderpriority").alias("model_name"),
                    F.col("o_orderdate").cast("timestamp").alias("ts"),
                    F.round(H.uniform("acc", F.col("o_orderkey")), 4).alias("accuracy"),
                    (F.col("o_orderkey") % 1000).alias("train_size"))


# ----------------------------------------------------------------- sql ----

def U(salt: str, key_sql: str) -> str:
    """DuckDB text of the md5 uniform."""
    return (f"(CAST(('0x' || substr(md5('{salt}' || ':' || CAST({key_sql} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")


def U_int(key_sql: str, salt: int) -> str:
    """DuckDB text of :func:`habiflow.functions.int_uniform`."""
    m = 4294967296
    x = f"((CAST({key_sql} AS BIGINT) * 2654435761 + {salt * 40503 + 12345}) % {m})"
    x = f"(({x} * 1597334677) % {m})"
    x = f"xor({x}, {x} >> 13)"
    x = f"(({x} * 1274126177) % {m})"
    return f"(xor({x}, {x} >> 16) / {float(m)})"


OCC_SQL = f"""
occ_src AS (
  SELECT event_id, ts, user_id, event_type, event_id AS ord FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, event_id + 1000000000 AS ord FROM events WHERE event_id % 50 = 7
),
occ_b AS (
  SELECT *, CAST(ts AS DATE) - CAST(floor(18000 * {U('day', 'event_id')}) AS INTEGER) AS obs FROM occ_src
),
occ AS (
  SELECT ord, event_id AS gbifID,
    CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 97 = 0 THEN 0.0
         ELSE 20 + 35 * {U('lat', 'event_id')} END AS decimalLatitude,
    CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 97 = 0 THEN 0.0
         ELSE -130 + 70 * {U('lon', 'event_id')} END AS decimalLongitude,
    CASE event_id % 6 WHEN 0 THEN strftime(obs, '%Y-%m-%d')
                      WHEN 1 THEN strftime(obs, '%Y-%m-%d') || {list(TIMES)!r}[event_id % 5 + 1]
                      WHEN 2 THEN strftime(obs, '%Y-%m') || '/' || strftime(obs, '%Y-%m') END AS eventDate,
    CASE WHEN event_id % 6 IN (2, 3, 4) THEN CAST(year(obs) AS DOUBLE) END AS year,
    CASE WHEN event_id % 6 IN (2, 3) THEN CAST(month(obs) AS DOUBLE) END AS month,
    CASE WHEN event_id % 6 IN (2, 3) THEN CAST(day(obs) AS DOUBLE) END AS day,
    CASE WHEN event_id % 6 = 4 THEN CAST(dayofyear(obs) AS DOUBLE) END AS startDayOfYear,
    CASE WHEN event_id % 6 = 5 AND event_id % 5 <> 0 THEN strftime(obs, '%Y %b %d') END AS verbatimEventDate,
    CASE WHEN event_id % 6 = 5 AND event_id % 5 = 0 THEN strftime(obs, '%Y-%m-%d') END AS dateIdentified,
    CASE event_type WHEN 'view' THEN 'US' WHEN 'click' THEN 'us' WHEN 'signup' THEN 'United States'
                    WHEN 'purchase' THEN 'CA' END AS countryCode,
    CASE event_id % 4 WHEN 0 THEN 'Idaho (愛達荷州)' WHEN 1 THEN 'Montana' WHEN 2 THEN ' New  York ' END AS stateProvince,
    'County ' || CAST(user_id % 20 AS VARCHAR) AS county,
    CASE WHEN event_id % 5 <> 0 THEN 'Town ' || CAST(user_id % 40 AS VARCHAR) END AS municipality,
    CASE event_id % 3 WHEN 1 THEN 'No specific locality recorded'
                      WHEN 2 THEN CASE WHEN ord = event_id THEN 'Site ' ELSE 'Again site ' END || CAST(user_id AS VARCHAR) END AS locality,
    CASE WHEN event_id % 7 = 1 THEN 'Canada, British Columbia'
         WHEN event_id % 7 = 2 THEN 'no verbatim locality recorded'
         WHEN event_id % 7 >= 3 THEN 'Trail near Site ' || CAST(user_id AS VARCHAR) END AS verbatimLocality,
    CASE WHEN event_id % 11 = 5 THEN 'ASIA' WHEN event_id % 11 <> 6 THEN 'NORTH_AMERICA' END AS continent,
    CASE event_id % 3 WHEN 0 THEN 'HumanObservation' WHEN 1 THEN 'PreservedSpecimen'
                      ELSE 'MachineObservation' END AS basisOfRecord,
    CASE WHEN event_id % 8 = 1 THEN round(3000 * {U('gelev', 'event_id')}) WHEN ord <> event_id THEN 1.0 END AS elevation
  FROM occ_b
)"""

_RKEY = "CAST(ilat AS VARCHAR) || ':' || CAST(ilon AS VARCHAR) || ':' || CAST(itime AS VARCHAR)"


def _raster_vars_sql() -> str:
    out = []
    for k, (name, (base, span)) in enumerate(zip(CLIMATE_VARS, VAR_RANGES)):
        v = f"({base} + {span} * {U_int('ckey', k + 1)})"
        if name == "air_temperature":
            v = f"CASE WHEN (7 * ilat + 3 * ilon + itime) % 41 <> 0 THEN {v} END"
        if name == "wind_speed":
            v = f"CASE WHEN (ilat + 2 * ilon + 5 * itime) % 37 = 0 THEN CAST('NaN' AS DOUBLE) ELSE {v} END"
        out.append(f"{v} AS {name}")
    return ",\n    ".join(out)


RASTER_SQL = f"""
raster_k AS (
  SELECT CAST(c_custkey AS INTEGER) AS itime, CAST(a.range AS INTEGER) AS ilat, CAST(b.range AS INTEGER) AS ilon
  FROM customer, range({LAT_AXIS.size}) a, range({LON_AXIS.size}) b
),
raster_h AS (
  SELECT *, (CAST(itime AS BIGINT) * {LAT_AXIS.size} + ilat) * {LON_AXIS.size} + ilon AS ckey FROM raster_k
),
raster AS (
  SELECT itime, ilat, ilon,
    DATE '{TIME_ORIGIN}' + CAST(itime * {TIME_STEP_DAYS} AS INTEGER) AS time,
    CAST({LAT_AXIS.origin} AS DOUBLE) + CAST({LAT_AXIS.step} AS DOUBLE) * ilat AS lat,
    CAST({LON_AXIS.origin} AS DOUBLE) + CAST({LON_AXIS.step} AS DOUBLE) * ilon AS lon,
    {_raster_vars_sql()}
  FROM raster_h
)"""

_CKEY = "CAST(ilat AS VARCHAR) || ':' || CAST(ilon AS VARCHAR)"

GRID_SQL = f"""
grid_cells AS (
  SELECT CAST(a.range AS INTEGER) AS ilat, CAST(b.range AS INTEGER) AS ilon
  FROM range({LAT_AXIS.size}) a, range({LON_AXIS.size}) b
)"""

ELEV_SQL = GRID_SQL + f""",
elev AS (
  SELECT ilat, ilon, CASE WHEN (ilat + ilon) % 13 <> 0 THEN round(4000 * {U('elev', _CKEY)}) END AS elevation
  FROM grid_cells
)"""

SOIL_SQL = GRID_SQL.replace("grid_cells", "grid_cells_s") + f""",
soil AS (
  SELECT ilat, ilon,
    CASE WHEN (ilat * ilon) % 17 <> 0 THEN
      '{{"properties":{{"layers":[{{"name":"clay","depths":[{{"values":{{"mean":1}}}}]}},{{"name":"phh2o","depths":[{{"values":{{"mean":'
      || CAST(CAST(40 + floor(45 * {U('soil', _CKEY)}) AS BIGINT) AS VARCHAR) || '}}}}]}}]}}}}' END AS body
  FROM grid_cells_s
)"""

GAZETTEER_SQL = f"""
gaz_keys AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN 'site ' ELSE 'camp ' END || CAST(c_custkey AS VARCHAR) AS place_key FROM customer
  UNION ALL SELECT 'town ' || CAST(range AS VARCHAR) FROM range(40) WHERE range % 2 = 0
  UNION ALL SELECT 'county ' || CAST(range AS VARCHAR) || ', montana, us' FROM range(40) WHERE range < 20
),
gazetteer AS (
  SELECT place_key, 24 + 25 * {U('glat', 'place_key')} AS lat, -124 + 57 * {U('glon', 'place_key')} AS lon
  FROM gaz_keys
)"""

MANUAL_SQL = f"""
manual_p AS (
  SELECT 'locality' AS kind, CASE WHEN c_custkey % 7 = 0 THEN 'Site ' ELSE 'Hut ' END || CAST(c_custkey AS VARCHAR) AS place
  FROM customer
  UNION ALL
  SELECT 'municipality', CASE WHEN c_custkey < 40 AND c_custkey % 5 = 0 THEN 'Town ' ELSE 'Village ' END
         || CAST(c_custkey AS VARCHAR) FROM customer
),
manual AS (
  SELECT kind, place, round(30 + 15 * {U('mlat', 'place')}, 6) AS lat,
         round(-120 + 40 * {U('mlon', 'place')}, 6) AS lon
  FROM manual_p
)"""

SCORED_SQL = OCC_SQL + f""",
scored AS (
  SELECT ord, gbifID, decimalLatitude, decimalLongitude,
    round({U('p', 'gbifID')}, 2) AS probability,
    CAST(round({U('p', 'gbifID')}, 2) >= 0.5 AS INTEGER) AS prediction,
    CAST({U('y', 'gbifID')} < round({U('p', 'gbifID')}, 2) AS INTEGER) AS label
  FROM occ WHERE decimalLatitude IS NOT NULL
)"""

IMPORTANCE_SQL = """
importance AS (
  SELECT g.p_brand AS model, g.p_type AS feature, g.s / t.t AS importance
  FROM (SELECT p_brand, p_type, sum(p_retailprice) AS s FROM part GROUP BY 1, 2) g
  JOIN (SELECT p_brand, sum(p_retailprice) AS t FROM part GROUP BY 1) t USING (p_brand)
)"""

RUNS_SQL = f"""
runs AS (
  SELECT o_orderkey AS version_id, o_orderpriority AS model_name, CAST(o_orderdate AS TIMESTAMP) AS ts,
         round({U('acc', 'o_orderkey')}, 4) AS accuracy, o_orderkey % 1000 AS train_size
  FROM orders
)"""


def with_(*ctes: str) -> str:
    """Join CTE bodies into one WITH clause."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
