"""Training table of the train job (L3), derived once per input folder.

presences (L1 clean, L2 geocoded) + pseudo-absences (K2), labelled before the
union (T1), season after it (T2) -> nearest-cell raster join (C1) ->
elevation (C3) and soil pH (C4) -> split and folds (E3/E4).
Written under the shared checkpoint folder and read back, so every model
job reuses it without recomputing the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow.operators import clean as C
from habiflow.operators import enrich as EN
from habiflow.operators import geocode as G
from habiflow.operators import raster as R
from habiflow.operators import sampling as SM
from habiflow.plans import fixtures as FX
from habiflow.session import cut_lineage

FEATURES = list(FX.CLIMATE_VARS) + ["elevation", "soil_ph", "year"]
ENV_FEATURES = list(FX.CLIMATE_VARS) + ["elevation", "soil_ph"]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: cleaned occurrences, written once per input folder: the geocoding reads them several times."""
    return FX.materialize(spark, "clean", sf_dir, ("events",), lambda: C.clean_occurrences(FX.occ(spark, sf_dir)))


def presences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 then L2: cleaned occurrences, geocoded where they lack coordinates (cascade, grid bounds,
    manual maps); rows still without any are dropped."""
    manual = FX.manual_geocodes(spark, sf_dir)
    g = G.geocode_cascade(cleaned(spark, sf_dir), FX.gazetteer(spark, sf_dir), manual)
    g = G.apply_manual(C.filter_grid_bounds(g), manual)
    g = C.drop_any_null(g, ["decimalLatitude", "decimalLongitude"])
    return g.select("gbifID", "decimalLatitude", "decimalLongitude", "datetime", "year", "month", "day", "elevation", "used_llm", "geocode_pos")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 up to the validation: presences and pseudo-absences with climate, elevation and soil; their own date parts."""
    spec = FX.raster_spec(spark, sf_dir)
    pres = cut_lineage(presences(spark, sf_dir))
    absn = SM.pseudo_absences(pres.select("decimalLatitude", "decimalLongitude", "datetime")).drop("occurrence")
    u = SM.label_and_union(pres, absn)
    u = u.withColumn("row_key", F.when(F.col("occurrence") == 1, F.concat(F.lit("p"), F.col("gbifID").cast("string")))
                     .otherwise(F.concat(F.lit("a"), F.col("attempt").cast("string"))))
    j = R.nearest_cell_join(u, FX.cube(spark, sf_dir), spec)
    j = EN.fill_elevation(j, FX.elev(spark), spec)
    return EN.fill_soil_ph(j, FX.soil(spark), spec)


def build_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = enriched(spark, sf_dir).select("row_key", "occurrence", "decimalLatitude", "decimalLongitude", "geocode_pos", "datetime", "month",
                                       "day", "season_num", "gridmet_lat", "gridmet_lon", "gridmet_date", *FEATURES)
    j = SM.train_test_split(j.na.drop(subset=FEATURES), "row_key", 0.2)
    return SM.stratified_folds(j, "occurrence", "row_key")


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.materialize(spark, "train", sf_dir, ("events", "customer"), lambda: build_training(spark, sf_dir),
                          version="v6")
