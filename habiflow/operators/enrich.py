"""Static lookups that replace per-row web calls.

Elevation and soil values live in cell-keyed tables (a digital elevation
model or a cached API response per cell).  Points are snapped to the cell
grid and left-joined; values only fill nulls (``coalesce``), so a value
already present in the occurrence dump survives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators.raster import RasterSpec, snap_cells

LAT, LON = "decimalLatitude", "decimalLongitude"


def fill_elevation(points: DataFrame, elev: DataFrame, spec: RasterSpec,
                   col: str = "elevation") -> DataFrame:
    """Elevation from the cell table, only where the row has none."""
    x = snap_cells(points, spec).withColumnRenamed("ilat", "__ilat").withColumnRenamed("ilon", "__ilon")
    e = elev.select(F.col("ilat").alias("__ilat"), F.col("ilon").alias("__ilon"),
                    F.col("elevation").alias("__elev"))
    j = x.join(e, ["__ilat", "__ilon"], "left")
    base = F.col(col) if col in points.columns else F.lit(None).cast("double")
    return j.withColumn(col, F.coalesce(base, F.col("__elev"))).drop("__ilat", "__ilon", "__elev")


def fill_soil_ph(points: DataFrame, soil: DataFrame, spec: RasterSpec,
                 col: str = "soil_ph") -> DataFrame:
    """C4: soil pH parsed from the cell's JSON payload, only where null."""
    x = snap_cells(points, spec).withColumnRenamed("ilat", "__ilat").withColumnRenamed("ilon", "__ilon")
    s = soil.select(F.col("ilat").alias("__ilat"), F.col("ilon").alias("__ilon"),
                    H.soil_ph("body").alias("__ph"))
    j = x.join(s, ["__ilat", "__ilon"], "left")
    base = F.col(col) if col in points.columns else F.lit(None).cast("double")
    return j.withColumn(col, F.coalesce(base, F.col("__ph"))).drop("__ilat", "__ilon", "__ph")


def elevation_payloads(points: DataFrame, key: str, elev_col: str = "elevation") -> DataFrame:
    """Elevation-service style JSON documents ``{"results":[{...}]}`` per point."""
    body = F.to_json(F.struct(F.array(F.struct(
        F.col(LAT).alias("latitude"), F.col(LON).alias("longitude"),
        F.col(elev_col).alias("elevation"))).alias("results")))
    return points.select(key, body.alias("body"))
