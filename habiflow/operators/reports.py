"""Scoring reports, rankings, set operations and run metadata
(SURVEY D11-D18, D21, E2, F1-F5, G2-G6, K14).

Top-k uses ``orderBy(...).limit(k)`` (Spark plans TakeOrderedAndProject:
each partition keeps k rows, then one merge of k x partitions rows), never a
collect of a whole group.  Per-group rankings use windows partitioned by a
key whose groups are bounded (features per model, runs per model name).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAT, LON = "decimalLatitude", "decimalLongitude"

# --- fixed values that must equal the reference's (do not edit) ----------
HIGH_CONFIDENCE = 0.8
MEDIUM_CONFIDENCE = 0.6
DEFAULT_THRESHOLD = 0.8
HIST_BINS = 20
TOP_LOCATIONS = 5
# --------------------------------------------------------------------------


def confidence_category(p: str = "probability") -> F.Column:
    c = F.col(p)
    return (F.when(c >= HIGH_CONFIDENCE, "high").when(c >= MEDIUM_CONFIDENCE, "medium")
             .when(c.isNotNull(), "low"))


def top_k(df: DataFrame, k: int, order: Sequence, cols: Sequence[str]) -> DataFrame:
    """k largest rows (TakeOrderedAndProject); ties by the later keys."""
    return df.orderBy(*order).limit(k).select(*cols)


def scoring_summary(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, key: str = "ord",
                    p: str = "probability") -> DataFrame:
    """One-row summary: totals, suitable count/percent, mean (4 dp),
    fixed-bin confidence counts and the top 5 locations (first row on ties)."""
    s = df.agg(F.count(F.lit(1)).alias("total_coordinates"),
               F.count_if(F.col(p) >= threshold).alias("suitable_habitat_count"),
               F.round(F.avg(p), 4).alias("average_confidence"),
               F.count_if(F.col(p) >= HIGH_CONFIDENCE).alias("high_confidence"),
               F.count_if((F.col(p) >= MEDIUM_CONFIDENCE) & (F.col(p) < HIGH_CONFIDENCE)).alias("medium_confidence"),
               F.count_if(F.col(p) < MEDIUM_CONFIDENCE).alias("low_confidence"))
    s = s.withColumn("suitability_percentage",
                     F.round(F.col("suitable_habitat_count") * 100.0 / F.col("total_coordinates"), 6))
    top = top_k(df, TOP_LOCATIONS, [F.col(p).desc(), F.col(key)], [key, LAT, LON, p])
    top_arr = top.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col(p)).alias("neg_p"), F.col(key).alias("k"), F.col(LAT).alias("lat"),
        F.col(LON).alias("lon"), F.col(p).alias("probability")))).alias("t"))
    top_arr = top_arr.select(F.transform("t", lambda e: F.struct(e["lat"].alias("lat"), e["lon"].alias("lon"),
                                                                e["probability"].alias("probability")))
                             .alias("top_locations"))
    return s.crossJoin(top_arr)


def confidence_bins(df: DataFrame, p: str = "probability") -> DataFrame:
    """Counts per confidence category."""
    return df.groupBy(confidence_category(p).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins between min and max, last bin closed; when
    min == max every value falls in one bin at that value."""
    ext = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    x = df.select(col).filter(F.col(col).isNotNull()).crossJoin(F.broadcast(ext))
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("__lo")) / w), F.lit(bins - 1))).cast("int")
    g = x.groupBy(b.alias("bin"), "__lo", "__hi").agg(F.count(F.lit(1)).alias("n"))
    wd = (F.col("__hi") - F.col("__lo")) / bins
    return g.select("bin", (F.col("__lo") + F.col("bin") * wd).alias("bin_lo"),
                    F.when(F.col("__hi") == F.col("__lo"), F.col("__hi"))
                     .otherwise(F.col("__lo") + (F.col("bin") + 1) * wd).alias("bin_hi"), "n")


def map_center(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, p: str = "probability") -> DataFrame:
    """Mean latitude/longitude of rows at or above the threshold."""
    return df.filter(F.col(p) >= threshold).agg(F.avg(LAT).alias("center_lat"), F.avg(LON).alias("center_lon"))


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target, one pass,
    unpivoted, with abs value (sort by ``abs_correlation`` desc)."""
    wide = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                    for i, f in enumerate(features)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("correlation"))
                     for i, f in enumerate(features)])
    return (wide.select(F.explode(rows).alias("r")).select("r.*")
                .withColumn("abs_correlation", F.abs("correlation")))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision / recall / F1 / support, plus macro and
    weighted averages (sklearn conventions, 0 when undefined)."""
    cm = confusion_matrix(df, label, pred)
    classes = cm.select(F.col(label).alias("cls")).union(cm.select(F.col(pred).alias("cls"))).distinct()
    tp = cm.filter(F.col(label) == F.col(pred)).select(F.col(label).alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col(label).alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col(pred).alias("cls")).agg(F.sum("n").alias("predicted"))
    r = (classes.join(tp, "cls", "left").join(sup, "cls", "left").join(prd, "cls", "left")
         .na.fill(0, ["tp", "support", "predicted"]))
    r = (r.withColumn("precision", F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0))
          .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)))
    r = r.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0))
    per = r.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                   F.col("support").cast("bigint").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                       F.sum("support").cast("bigint").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def topn_per_group(df: DataFrame, group: str, order_col: str, n: int, tie: str) -> DataFrame:
    """Top-n rows per group (window partitioned by the group key)."""
    w = Window.partitionBy(group).orderBy(F.col(order_col).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def topk_with_others(df: DataFrame, group: str, feature: str, value: str, k: int) -> DataFrame:
    """Per group the top-k rows and one 'Others' row with the remainder;
    ``all_zero`` flags groups whose values are all zero."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(feature))
    r = df.withColumn("__r", F.row_number().over(w))
    label = F.when(F.col("__r") <= k, F.col(feature)).otherwise(F.lit("Others"))
    out = r.groupBy(group, label.alias(feature)).agg(F.sum(value).alias(value))
    z = df.groupBy(group).agg(F.bool_and(F.col(value) == 0).alias("all_zero"))
    return out.join(z, group)


def common_features(topn: DataFrame, group: str = "model", feature: str = "feature") -> DataFrame:
    """Features present in the top-n list of every group."""
    n_groups = topn.agg(F.count_distinct(group).alias("__g"))
    per = topn.groupBy(feature).agg(F.count_distinct(group).alias("__n"))
    return per.crossJoin(F.broadcast(n_groups)).filter(F.col("__n") == F.col("__g")).select(feature)


def latest_by(df: DataFrame, group: str, ts: str, tie: str) -> DataFrame:
    """The latest row per group (max timestamp, tie by key), via an
    aggregate (map-side combined), not a window."""
    others = [c for c in df.columns if c != group]
    a = df.groupBy(group).agg(F.max_by(F.struct(*others), F.struct(F.col(ts), F.col(tie))).alias("__r"))
    return a.select(group, *[F.col("__r")[c].alias(c) for c in others])


def runs_by_id(runs: DataFrame, ids: DataFrame, key: str = "version_id") -> DataFrame:
    """The run of each wanted id, null columns and ``found`` = false where there is none."""
    return (ids.select(key).distinct().join(runs.withColumn("found", F.lit(True)), key, "left")
            .withColumn("found", F.coalesce("found", F.lit(False))))


def metrics_by_id(runs: DataFrame, ids: DataFrame, doc: str = "metrics", key: str = "version_id") -> DataFrame:
    """``key, metric, value`` of the wanted runs from their nested metric documents.

    ``doc`` is a JSON text ``{metric: number}`` or ``{group: {metric: number}}``; the latter's names are ``group.metric``.
    """
    wanted = runs.join(ids.select(key).distinct(), key, "left_semi")
    flat = F.from_json(doc, "map<string,string>")
    one = wanted.select(key, F.explode(flat).alias("name", "body"))
    inner = F.from_json("body", "map<string,double>")
    nested = (one.filter(F.col("body").startswith("{")).select(key, "name", F.explode(inner).alias("part", "value"))
              .select(key, F.concat_ws(".", "name", "part").alias("metric"), "value"))
    plain = one.filter(~F.col("body").startswith("{")).select(key, F.col("name").alias("metric"), F.col("body").try_cast("double").alias("value"))
    return plain.unionByName(nested)


def current_runs(runs: DataFrame, pointers: DataFrame, as_of: str | None = None, group: str = "model_name", key: str = "version_id",
                 set_at: str = "set_at") -> DataFrame:
    """The run that each model's "current" pointer names, now or as of a time.

    ``pointers`` logs every setting of the pointer; the last one up to ``as_of``
    counts (ties by the larger id).  A pointer to a run that is gone keeps its row.
    """
    log = pointers if as_of is None else pointers.filter(F.col(set_at) <= F.lit(as_of).cast("timestamp"))
    last = log.groupBy(group).agg(F.max(F.struct(set_at, key)).alias("p")).select(group, f"p.{set_at}", f"p.{key}")
    return last.join(runs.drop(group), key, "left")


def compare_models(importance: DataFrame, models: Sequence[str], n: int = 10) -> DataFrame:
    """The top ``n`` features of the wanted models, one table; models without a row are left out (see :func:`missing_models`)."""
    return topn_per_group(importance.filter(F.col("model").isin(list(models))), "model", "importance", n, "feature")


def missing_models(importance: DataFrame, models: Sequence[str]) -> DataFrame:
    """G2 warning: wanted models that the table has nothing of."""
    wanted = importance.sparkSession.createDataFrame([(m,) for m in models], "model string")
    return wanted.join(importance.select("model").distinct(), "model", "left_anti")


def compare_runs(runs: DataFrame, group: str = "model_name", ts: str = "ts", key: str = "version_id",
                 metric: str = "accuracy") -> DataFrame:
    """Per model name, the latest run and the best run side by side."""
    a = runs.groupBy(group).agg(
        F.max_by(F.struct(key, metric, ts), F.struct(F.col(ts), F.col(key))).alias("latest"),
        F.max_by(F.struct(key, metric, ts), F.struct(F.col(metric), F.col(key))).alias("best"),
        F.count(F.lit(1)).alias("n_runs"))
    return a.select(group, "n_runs",
                    F.col(f"latest.{key}").alias("latest_version"), F.col(f"latest.{metric}").alias("latest_accuracy"),
                    F.col(f"best.{key}").alias("best_version"), F.col(f"best.{metric}").alias("best_accuracy"),
                    (F.col(f"best.{metric}") - F.col(f"latest.{metric}")).alias("accuracy_gap"))


def yield_score(df: DataFrame, weights: tuple[float, float, float] = (0.4, 0.3, 0.3),
                max_lbs: float = 200.0, buckets: int = 5) -> DataFrame:
    """K14 [plan]: weighted sum of normalised radiation, precipitation and
    soil-pH closeness to 5.5, scaled to lbs/acre, then equal-width buckets."""
    srad = F.least(F.greatest((F.col("surface_downwelling_shortwave_flux_in_air") - 50) / 320.0, F.lit(0.0)), F.lit(1.0))
    prec = F.least(F.greatest(F.col("precipitation_amount") / 10.0, F.lit(0.0)), F.lit(1.0))
    ph = F.greatest(F.lit(0.0), 1 - F.abs(F.col("soil_ph") - 5.5) / 3.0)
    score = F.lit(weights[0]) * srad + F.lit(weights[1]) * prec + F.lit(weights[2]) * F.coalesce(ph, F.lit(0.0))
    lbs = F.round(score * max_lbs, 6)
    width = max_lbs / buckets
    return (df.withColumn("yield_lbs_acre", lbs)
              .withColumn("yield_bucket", F.least(F.floor(F.col("yield_lbs_acre") / width), F.lit(buckets - 1)).cast("int")))
