"""The train and score jobs from their prepared tables on: checks, fits, outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow import sources as SRC
from habiflow.operators import clean as C
from habiflow.operators import enrich as EN
from habiflow.operators import model as M
from habiflow.operators import quality as Q
from habiflow.operators import raster as R
from habiflow.operators import reports as RP

ESSENTIAL = ("decimalLatitude", "decimalLongitude", "year", "month", "day", "datetime", "occurrence")


def require_valid(df: DataFrame, expected: Sequence[str], temporal_required: bool = True) -> DataFrame:
    """D8 as a gate: ``df`` itself, or an error that names the first rule it breaks and how often."""
    report = Q.validation_report(df, expected, temporal_required)
    broken = report.filter("violations > 0").orderBy("ord").collect()  # a row a rule
    if broken:
        raise ValueError("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))
    return df


def importance_report(models: dict[str, tuple[PipelineModel, Sequence[str]]], spark: SparkSession, wanted: Sequence[str] | None = None) -> DataFrame:
    """The importances of all (or the wanted) models, with their rank; unknown names are left out."""
    names = [n for n in (wanted if wanted is not None else models) if n in models]
    parts = [M.importances(*models[n], spark).select(F.lit(n).alias("model"), "feature", "importance") for n in names]
    out = spark.createDataFrame([], "model string, feature string, importance double")
    for p in parts:
        out = out.unionByName(p)
    return RP.topn_per_group(out, "model", "importance", 1 << 30, "feature")


def train(spark: SparkSession, table: DataFrame, features: Sequence[str], variables: Sequence[str], out: str,
          label: str = "occurrence") -> DataFrame:
    """L3 from the enriched table on; ``table`` has ``row_key`` and ``is_test``.

    Written under ``out``: ``processed`` (essential columns), ``enriched``
    (modeling columns), ``model``, ``importance`` and ``run``.  Returns the run
    row: accuracy, sizes, label counts, fingerprint, validation, top features
    and the essential columns that were missing.
    """
    require_valid(table, [*features, label])
    SRC.write_table(C.select_available(table, ESSENTIAL), f"{out}/processed", "csv")
    modeling, missing = C.modeling_columns(table, variables, label)
    SRC.write_table(modeling, f"{out}/enriched", "csv")
    model = M.random_forest(features, label, trees=100, depth=6).fit(table.filter(~F.col("is_test")))
    M.save_model(model, features, f"{out}/model")
    report = importance_report({"random_forest": (model, features)}, spark)
    SRC.write_table(report, f"{out}/importance", "csv")
    accuracy = RP.accuracy(M.score(model, table.filter("is_test"), ["row_key", label]), label, "prediction")
    sizes = table.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"),
                      F.count_if(F.col(label) == 1).alias("n_presence"), F.count_if(F.col(label) == 0).alias("n_absence"))
    top = report.filter("rank <= 3").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "feature"))), lambda e: e["feature"])
                                         .alias("top_features"))
    # one row each
    run = (accuracy.select(F.lit("random_forest").alias("model_type"), "accuracy").crossJoin(sizes)
           .crossJoin(Q.fingerprint(table.select("row_key", label)).select("fingerprint")).crossJoin(top)
           .withColumns({"passed": F.lit(True), "missing_columns": F.lit(len(missing))}))
    SRC.write_json_summary(run, f"{out}/run")
    return spark.read.schema(run.schema).json(f"{out}/run")


def score_features(points: DataFrame, raster: DataFrame, spec: R.RasterSpec, elev: DataFrame, soil: DataFrame, features: Sequence[str],
                   target_date: str | None = None) -> DataFrame:
    """L4 up to the model: checked points with everything a model asks for; a missing number counts as zero."""
    require_valid(points, ["decimalLatitude", "decimalLongitude"], temporal_required=False)
    g = R.nearest_cell_join(points, raster, spec, target_date=target_date)
    g = EN.fill_soil_ph(EN.fill_elevation(g, elev, spec), soil, spec)
    day = F.col("gridmet_date")
    g = g.withColumns({"year": F.year(day).cast("double"), "month": F.month(day).cast("double"), "day": F.dayofmonth(day).cast("double")})
    g = g.withColumn("season_num", H.season_num("month"))
    M.require_features(g, features)
    return C.fill_zero(g, features)


def score(spark: SparkSession, model: PipelineModel, table: DataFrame, out: str, threshold: float = 0.8, key: str = "ord") -> DataFrame:
    """L4 from the features on.

    Written under ``out``: ``predictions``, ``top_predictions`` (at or above the
    threshold, best first), ``confidence`` (bins), ``histogram``, ``center`` and
    ``markers`` (GeoJSON-like) of the map, ``summary``.  Returns the summary row.
    """
    p = M.score(model, table, [key, "decimalLatitude", "decimalLongitude"])
    SRC.write_table(p, f"{out}/predictions")
    p = spark.read.schema(p.schema).parquet(f"{out}/predictions")  # scored once
    SRC.write_above_threshold(p, f"{out}/top_predictions", threshold)
    SRC.write_table(RP.confidence_bins(p), f"{out}/confidence")
    SRC.write_table(RP.histogram(p, "probability"), f"{out}/histogram")
    SRC.write_table(RP.map_center(p, threshold), f"{out}/center")
    SRC.write_table(p.select(key, H.marker_json("decimalLatitude", "decimalLongitude", "probability").alias("feature")), f"{out}/markers")
    summary = RP.scoring_summary(p, threshold, key)
    SRC.write_table(summary, f"{out}/summary")
    return spark.read.schema(summary.schema).parquet(f"{out}/summary")
