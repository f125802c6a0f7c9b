"""Report / ranking / set / run-metadata queries (SURVEY D11-D19, D21, D23,
D24, E2, F1-F3, G2-G4, G6, K14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from habiflow import streaming as ST
from habiflow.operators import clean as C
from habiflow.operators import enrich as EN
from habiflow.operators import raster as R
from habiflow.operators import reports as RP
from habiflow.operators import sampling as SM
from habiflow.plans import fixtures as FX
from habiflow.plans import sqlparts as S
from habiflow.plans.fixtures import U, with_
from habiflow.plans.registry import query

SC = FX.SCORED_SQL


def r6(c):
    return F.round(c, 6)


@query("agg_scoring_summary", with_(SC) + """
SELECT count(*) AS total_coordinates, CAST(count_if(probability >= 0.8) AS BIGINT) AS suitable_habitat_count,
       round(avg(probability), 4) AS average_confidence,
       CAST(count_if(probability >= 0.8) AS BIGINT) AS high_confidence,
       CAST(count_if(probability >= 0.6 AND probability < 0.8) AS BIGINT) AS medium_confidence,
       CAST(count_if(probability < 0.6) AS BIGINT) AS low_confidence,
       round(count_if(probability >= 0.8) * 100.0 / count(*), 6) AS suitability_percentage,
       (SELECT list(struct_pack(lat := decimalLatitude, lon := decimalLongitude, probability := probability)
                    ORDER BY probability DESC, ord)
        FROM (SELECT * FROM scored ORDER BY probability DESC, ord LIMIT 5)) AS top_locations
FROM scored""")
def q_agg_scoring_summary(spark, sf_dir):
    """Scoring summary with fixed bins and the top-5 locations."""
    return RP.scoring_summary(FX.scored(spark, sf_dir), 0.8)


@query("agg_confidence_bins", with_(SC) + """
SELECT CASE WHEN probability >= 0.8 THEN 'high' WHEN probability >= 0.6 THEN 'medium'
            WHEN probability IS NOT NULL THEN 'low' END AS category, count(*) AS n
FROM scored GROUP BY 1""")
def q_agg_confidence_bins(spark, sf_dir):
    """Confidence category counts."""
    return RP.confidence_bins(FX.scored(spark, sf_dir))


@query("agg_histogram", with_(SC, """
e AS (SELECT min(probability) AS lo, max(probability) AS hi FROM scored)""") + """
SELECT bin, round(lo + bin * (hi - lo) / 20, 6) AS bin_lo,
       round(CASE WHEN hi = lo THEN hi ELSE lo + (bin + 1) * (hi - lo) / 20 END, 6) AS bin_hi, count(*) AS n
FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((probability - lo) / ((hi - lo) / 20)), 19) END AS INTEGER)
             AS bin, lo, hi FROM scored, e WHERE probability IS NOT NULL)
GROUP BY bin, lo, hi""")
def q_agg_histogram(spark, sf_dir):
    """20-bin histogram of the probability."""
    h = RP.histogram(FX.scored(spark, sf_dir), "probability", 20)
    return h.select("bin", r6(F.col("bin_lo")).alias("bin_lo"), r6(F.col("bin_hi")).alias("bin_hi"), "n")


@query("agg_map_center", with_(SC) + """
SELECT round(avg(decimalLatitude), 6) AS center_lat, round(avg(decimalLongitude), 6) AS center_lon
FROM scored WHERE probability >= 0.8""")
def q_agg_map_center(spark, sf_dir):
    """Map centre of the suitable points."""
    m = RP.map_center(FX.scored(spark, sf_dir), 0.8)
    return m.select(r6(F.col("center_lat")).alias("center_lat"), r6(F.col("center_lon")).alias("center_lon"))


@query("agg_target_correlation", with_(SC) + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(corr({f}, label), 6) AS correlation, round(abs(corr({f}, label)), 6) AS abs_correlation FROM scored"
    for f in ("decimalLatitude", "decimalLongitude", "probability", "prediction")))
def q_agg_target_correlation(spark, sf_dir):
    """D15 + F4: feature-target correlations (sort by abs desc)."""
    c = RP.target_correlation(FX.scored(spark, sf_dir),
                              ["decimalLatitude", "decimalLongitude", "probability", "prediction"], "label")
    return (c.select("feature", r6(F.col("correlation")).alias("correlation"),
                     r6(F.col("abs_correlation")).alias("abs_correlation"))
             .orderBy(F.col("abs_correlation").desc()))


@query("agg_accuracy", with_(SC) + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM scored""")
def q_agg_accuracy(spark, sf_dir):
    """Accuracy."""
    a = RP.accuracy(FX.scored(spark, sf_dir))
    return a.select(r6(F.col("accuracy")).alias("accuracy"), "n")


@query("agg_confusion_matrix", with_(SC) + """
SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2""")
def q_agg_confusion_matrix(spark, sf_dir):
    """Confusion matrix."""
    return RP.confusion_matrix(FX.scored(spark, sf_dir))


@query("agg_classification_report", with_(SC, """
cm AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2),
cls AS (SELECT label AS c FROM cm UNION SELECT prediction FROM cm),
r AS (
  SELECT c, coalesce((SELECT sum(n) FROM cm WHERE label = c AND prediction = c), 0) AS tp,
         coalesce((SELECT sum(n) FROM cm WHERE label = c), 0) AS support,
         coalesce((SELECT sum(n) FROM cm WHERE prediction = c), 0) AS predicted FROM cls),
p AS (
  SELECT CAST(c AS VARCHAR) AS class,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, CAST(support AS BIGINT) AS support FROM r),
q AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM p),
allr AS (
  SELECT class, precision, recall, f1, support FROM q
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM q
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM q)""") + """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM allr""")
def q_agg_classification_report(spark, sf_dir):
    """Per-class precision/recall/F1/support with macro and weighted rows."""
    r = RP.classification_report(FX.scored(spark, sf_dir))
    return r.select("class", *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


IMP = FX.IMPORTANCE_SQL


@query("win_topn_per_model", with_(IMP) + """
SELECT model, feature, round(importance, 6) AS importance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rank FROM importance)
WHERE rank <= 10""")
def q_win_topn_per_model(spark, sf_dir):
    """Top-10 features per model."""
    t = RP.topn_per_group(FX.importance(spark, sf_dir), "model", "importance", 10, "feature")
    return t.select("model", "feature", r6(F.col("importance")).alias("importance"), F.col("rank"))


@query("agg_topk_others", with_(IMP, """
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rk FROM importance),
z AS (SELECT model, bool_and(importance = 0) AS all_zero FROM importance GROUP BY model)""") + """
SELECT r.model, CASE WHEN rk <= 3 THEN feature ELSE 'Others' END AS feature, round(sum(importance), 6) AS importance,
       z.all_zero
FROM r JOIN z USING (model) GROUP BY r.model, 2, z.all_zero""")
def q_agg_topk_others(spark, sf_dir):
    """Top-3 per model plus an 'Others' remainder; all-zero check."""
    t = RP.topk_with_others(FX.importance(spark, sf_dir), "model", "feature", "importance", 3)
    return t.select("model", "feature", r6(F.col("importance")).alias("importance"), "all_zero")


@query("srt_importance_head", with_(IMP) + """
SELECT model, feature, round(importance, 6) AS importance FROM importance
ORDER BY importance DESC, model, feature LIMIT 10""")
def q_srt_importance_head(spark, sf_dir):
    """sort importances desc, head(10)."""
    t = RP.top_k(FX.importance(spark, sf_dir), 10, [F.col("importance").desc(), "model", "feature"],
                 ["model", "feature", "importance"])
    return t.select("model", "feature", r6(F.col("importance")).alias("importance"))


@query("srt_top_predictions", with_(SC) + """
SELECT ord, decimalLatitude, decimalLongitude, probability FROM scored WHERE probability >= 0.8""")
def q_srt_top_predictions(spark, sf_dir):
    """predictions >= threshold sorted by probability desc (range-partitioned sort)."""
    s = C.filter_threshold(FX.scored(spark, sf_dir), 0.8)
    return s.orderBy(F.col("probability").desc(), "ord").select("ord", "decimalLatitude", "decimalLongitude",
                                                                "probability")


@query("srt_nlargest", with_(SC) + """
SELECT ord, decimalLatitude, decimalLongitude, probability FROM scored ORDER BY probability DESC, ord LIMIT 5""")
def q_srt_nlargest(spark, sf_dir):
    """nlargest(5, probability), first row wins ties."""
    return RP.top_k(FX.scored(spark, sf_dir), 5, [F.col("probability").desc(), "ord"],
                    ["ord", "decimalLatitude", "decimalLongitude", "probability"])


_WANTED = ("Brand#11", "Brand#12", "Brand#99", "Brand#55")   # no part has the third


@query("set_model_compare", with_(IMP) + f"""
SELECT model, feature, round(importance, 6) AS importance, false AS missing FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rk FROM importance
  WHERE model IN {_WANTED})
WHERE rk <= 10
UNION ALL
SELECT m, NULL, NULL, true FROM (SELECT unnest({list(_WANTED)}) AS m) WHERE m NOT IN (SELECT model FROM importance)""")
def q_set_model_compare(spark, sf_dir):
    """The top-10 features of the wanted models; models that are missing are skipped and named."""
    i = FX.importance(spark, sf_dir)
    t = RP.compare_models(i, _WANTED).select("model", "feature", r6(F.col("importance")).alias("importance"), F.lit(False).alias("missing"))
    gone = RP.missing_models(i, _WANTED).select("model", F.lit(None).cast("string").alias("feature"),
                                                F.lit(None).cast("double").alias("importance"), F.lit(True).alias("missing"))
    return t.unionByName(gone)


@query("set_importance_report", with_(IMP) + """
SELECT 'by_brand' AS report, model, feature, round(importance, 6) AS importance FROM importance
UNION ALL
SELECT 'by_size', 'size_' || CAST(p_size AS VARCHAR), p_type, round(sum(p_retailprice) / sum(sum(p_retailprice))
       OVER (PARTITION BY p_size), 6) FROM part GROUP BY p_size, p_type""")
def q_set_importance_report(spark, sf_dir):
    """Several importance tables concatenated into one report (unionByName)."""
    a = FX.importance(spark, sf_dir).select(F.lit("by_brand").alias("report"), "model", "feature",
                                            r6(F.col("importance")).alias("importance"))
    p = FX.read(spark, sf_dir, "part")
    g = p.groupBy("p_size", "p_type").agg(F.sum("p_retailprice").alias("s"))
    t = p.groupBy("p_size").agg(F.sum("p_retailprice").alias("t"))
    b = g.join(t, "p_size").select(F.lit("by_size").alias("report"),
                                   F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("model"),
                                   F.col("p_type").alias("feature"), r6(F.col("s") / F.col("t")).alias("importance"))
    return a.unionByName(b)


@query("set_common_features", """
WITH importance AS (SELECT substr(p_brand, 1, 7) AS model, p_type AS feature, sum(p_retailprice) AS importance FROM part GROUP BY 1, 2),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS rk
                     FROM importance) WHERE rk <= 5)
SELECT feature FROM t GROUP BY feature HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM t)""")
def q_set_common_features(spark, sf_dir):
    """Features in every model's top-5 (groups of brands as models)."""
    p = FX.read(spark, sf_dir, "part")
    i = p.groupBy(F.substring("p_brand", 1, 7).alias("model"), F.col("p_type").alias("feature")).agg(F.sum("p_retailprice").alias("importance"))
    return RP.common_features(RP.topn_per_group(i, "model", "importance", 5, "feature"))


@query("set_identical", with_(IMP, """
a AS (SELECT model, feature FROM importance WHERE importance > 0.01),
b AS (SELECT model, feature FROM importance WHERE NOT importance <= 0.01),
c AS (SELECT model, feature FROM importance WHERE importance > 0.012)""") + """
SELECT (SELECT count(*) FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a))) = 0
         AS identical_same,
       (SELECT count(*) FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM c) UNION ALL (SELECT * FROM c EXCEPT ALL SELECT * FROM a))) = 0
         AS identical_shifted""")
def q_set_identical(spark, sf_dir):
    """Frame equality by exceptAll both ways (the same rows found another
    way are identical; a stricter cut is not)."""
    from habiflow.sources import identical
    i = FX.importance(spark, sf_dir)
    cut = lambda c: i.filter(c).select("model", "feature")
    a, b, c = cut("importance > 0.01"), cut("NOT importance <= 0.01"), cut("importance > 0.012")
    return identical(a, b).withColumnRenamed("identical", "identical_same").crossJoin(
        identical(a, c).withColumnRenamed("identical", "identical_shifted"))


RUNS = FX.RUNS_SQL


@query("agg_latest_run_by_name", with_(RUNS) + """
SELECT model_name, arg_max(version_id, (ts, version_id)) AS version_id, max(ts) AS ts,
       arg_max(accuracy, (ts, version_id)) AS accuracy, arg_max(train_size, (ts, version_id)) AS train_size
FROM runs GROUP BY model_name""")
def q_agg_latest_run_by_name(spark, sf_dir):
    """Latest run per model name (max timestamp, tie by id)."""
    return RP.latest_by(FX.runs(spark, sf_dir), "model_name", "ts", "version_id")


_IDS = "SELECT DISTINCT c_custkey * 2 AS version_id FROM customer"


@query("agg_run_by_id", with_(RUNS) + f"""
SELECT i.version_id, model_name, ts, accuracy, train_size, r.version_id IS NOT NULL AS found
FROM ({_IDS}) i LEFT JOIN runs r USING (version_id)""")
def q_agg_run_by_id(spark, sf_dir):
    """Runs by id; ids without a run say so."""
    ids = FX.read(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("version_id"))
    return RP.runs_by_id(FX.runs(spark, sf_dir), ids)


@query("agg_run_metrics", with_(RUNS) + f"""
, w AS (SELECT r.* FROM runs r WHERE version_id IN ({_IDS}))
SELECT version_id, 'accuracy' AS metric, accuracy AS value FROM w
UNION ALL SELECT version_id, 'train_size', CAST(train_size AS DOUBLE) FROM w
UNION ALL SELECT version_id, 'presence.recall', accuracy / 2 FROM w
UNION ALL SELECT version_id, 'presence.support', CAST(train_size AS DOUBLE) FROM w""")
def q_agg_run_metrics(spark, sf_dir):
    """The metrics of runs by id, from nested documents."""
    r = FX.runs(spark, sf_dir)
    doc = F.to_json(F.struct("accuracy", "train_size", F.struct((F.col("accuracy") / 2).alias("recall"),
                                                                F.col("train_size").alias("support")).alias("presence")))
    ids = FX.read(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("version_id"))
    return RP.metrics_by_id(r.select("version_id", doc.alias("metrics")), ids)


def _pointers(spark, sf_dir):
    """A "current" pointer is set by every order of status F, to the run of twice its key: not all of these exist."""
    o = FX.read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return o.select(F.col("o_orderpriority").alias("model_name"), (F.col("o_orderkey") * 2).alias("version_id"),
                    F.col("o_orderdate").cast("timestamp").alias("set_at"))


@query("agg_current_run", with_(RUNS) + """
, p AS (SELECT o_orderpriority AS model_name, o_orderkey * 2 AS version_id, CAST(o_orderdate AS TIMESTAMP) AS set_at
        FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT 'now' AS as_of, model_name, max((set_at, version_id)) AS x FROM p GROUP BY model_name
      UNION ALL
      SELECT '1998-06-30', model_name, max((set_at, version_id)) FROM p WHERE set_at <= TIMESTAMP '1998-06-30' GROUP BY model_name)
SELECT as_of, l.model_name, x[2] AS version_id, x[1] AS set_at, r.accuracy, r.train_size
FROM l LEFT JOIN runs r ON r.version_id = x[2]""")
def q_agg_current_run(spark, sf_dir):
    """The current run of each model, now and as of an earlier day."""
    r, p = FX.runs(spark, sf_dir), _pointers(spark, sf_dir)
    parts = [RP.current_runs(r, p, day).withColumn("as_of", F.lit(day or "now")) for day in (None, "1998-06-30")]
    return parts[0].unionByName(parts[1]).select("as_of", "model_name", "version_id", "set_at", "accuracy", "train_size")


@query("agg_compare_runs", with_(RUNS) + """
SELECT model_name, count(*) AS n_runs,
       arg_max(version_id, (ts, version_id)) AS latest_version, arg_max(accuracy, (ts, version_id)) AS latest_accuracy,
       arg_max(version_id, (accuracy, version_id)) AS best_version, arg_max(accuracy, (accuracy, version_id)) AS best_accuracy,
       round(arg_max(accuracy, (accuracy, version_id)) - arg_max(accuracy, (ts, version_id)), 6) AS accuracy_gap
FROM runs GROUP BY model_name""")
def q_agg_compare_runs(spark, sf_dir):
    """Latest vs best run per model name, metrics flattened."""
    c = RP.compare_runs(FX.runs(spark, sf_dir))
    return c.withColumn("accuracy_gap", r6(F.col("accuracy_gap")))


@query("agg_standardize", with_(SC) + """
SELECT 'decimalLatitude' AS feature, round(avg(decimalLatitude), 6) AS mean, round(stddev_pop(decimalLatitude), 6) AS std FROM scored
UNION ALL SELECT 'decimalLongitude', round(avg(decimalLongitude), 6), round(stddev_pop(decimalLongitude), 6) FROM scored
UNION ALL SELECT 'probability', round(avg(probability), 6), round(stddev_pop(probability), 6) FROM scored""")
def q_agg_standardize(spark, sf_dir):
    """Standardisation statistics with the population std."""
    from habiflow.operators import model as M
    s = M.standardize_stats(FX.scored(spark, sf_dir), ["decimalLatitude", "decimalLongitude", "probability"])
    return s.select("feature", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


_NB_FEATS = (("lat_hi", "decimalLatitude - 40"), ("lon_east", "decimalLongitude + 100"), ("p_hi", "probability - 0.5"))


@query("agg_bernoulli_nb", with_(SC) + " UNION ALL ".join(
    f"SELECT label AS class, '{n}' AS feature, round((sum(CASE WHEN {e} > 0 THEN 1 ELSE 0 END) + 10.0) / (count(*) + 20.0), 6)"
    f" AS theta FROM scored GROUP BY label" for n, e in _NB_FEATS))
def q_agg_bernoulli_nb(spark, sf_dir):
    """Bernoulli naive Bayes parameters (binarised at 0, alpha = 10)."""
    from habiflow.operators import model as M
    s = FX.scored(spark, sf_dir).select(
        "label", *[F.expr(e).alias(n) for n, e in _NB_FEATS])
    t = M.bernoulli_nb_fit(s, [n for n, _ in _NB_FEATS], "label", alpha=10.0)
    return t.select(F.col("label").alias("class"), "feature", r6(F.col("theta")).alias("theta"))


@query("agg_cv_summary", with_(SC, f"""
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {U('fold', 'ord')}, ord) - 1) % 5 AS INTEGER) AS fold
      FROM scored),
a AS (SELECT fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc FROM f GROUP BY fold)""") + """
SELECT round(avg(acc), 6) AS cv_mean, round(stddev_pop(acc), 6) AS cv_std,
       round(avg(acc) - 2 * stddev_pop(acc), 6) AS cv_low, round(avg(acc) + 2 * stddev_pop(acc), 6) AS cv_high,
       count(*) AS folds
FROM a""")
def q_agg_cv_summary(spark, sf_dir):
    """Per-fold accuracy (stratified 5 folds) -> mean +- 2 std."""
    from habiflow.operators import model as M
    s = SM.stratified_folds(FX.scored(spark, sf_dir), "label", "ord")
    return M.cv_summary(s, "fold", "label", "prediction")


@query("agg_overfit_verdict", with_(SC, f"""
s AS (SELECT *, row_number() OVER (ORDER BY {U('split', 'ord')}, ord) - 1 < ceil(count(*) OVER () * 0.2 - 1e-9) AS is_test
      FROM scored),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {U('fold', 'ord')}, ord) - 1) % 5 AS INTEGER) AS fold
      FROM scored),
cv AS (SELECT stddev_pop(acc) AS cv_std FROM (SELECT fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc
                                              FROM f GROUP BY fold)),
tt AS (SELECT avg(CASE WHEN NOT is_test THEN CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END END) AS train_acc,
              avg(CASE WHEN is_test THEN CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END END) AS test_acc FROM s)""") + """
SELECT round(train_acc, 6) AS train_accuracy, round(test_acc, 6) AS test_accuracy,
       round(train_acc - test_acc, 6) AS gap, round(cv_std, 6) AS cv_std,
       CASE WHEN train_acc - test_acc > 0.05 THEN 'overfitting' ELSE 'ok' END AS gap_verdict,
       CASE WHEN cv_std > 0.1 THEN 'unstable' ELSE 'stable' END AS cv_verdict
FROM tt, cv""")
def q_agg_overfit_verdict(spark, sf_dir):
    """train/test gap vs 0.05 and CV std vs 0.1."""
    from habiflow.operators import model as M
    sc = FX.scored(spark, sf_dir)
    split = SM.train_test_split(sc, "ord", 0.2)
    folds = SM.stratified_folds(sc, "label", "ord")
    return M.overfit_verdict(split, folds, "label", "prediction")


@query("ml_yield_score", with_(FX.OCC_SQL, FX.RASTER_SQL, S.clean_ctes(), S.nearest_join_ctes("clean"), FX.SOIL_SQL) + f"""
, y AS (
  SELECT j.gbifID,
    least(greatest((j.surface_downwelling_shortwave_flux_in_air - 50) / 320.0, 0.0), 1.0) AS srad,
    least(greatest(j.precipitation_amount / 10.0, 0.0), 1.0) AS prec,
    greatest(0.0, 1 - abs(round(CAST(json_extract(list_filter(CAST(json_extract(s.body, '$.properties.layers') AS JSON[]),
      lambda l: json_extract_string(l, '$.name') = 'phh2o')[1], '$.depths[0].values.mean') AS DOUBLE) / 10, 2) - 5.5) / 3.0) AS ph
  FROM joined j LEFT JOIN soil s
    ON s.ilat = {FX.LAT_AXIS.sql_index('j.decimalLatitude')} AND s.ilon = {FX.LON_AXIS.sql_index('j.decimalLongitude')})
SELECT gbifID, round((0.4 * srad + 0.3 * prec + 0.3 * coalesce(ph, 0.0)) * 200.0, 6) AS yield_lbs_acre,
       CAST(least(floor(round((0.4 * srad + 0.3 * prec + 0.3 * coalesce(ph, 0.0)) * 200.0, 6) / 40.0), 4) AS INTEGER) AS yield_bucket
FROM y""".replace("WITH ", "WITH ", 1))
def q_ml_yield_score(spark, sf_dir):
    """K14 [plan]: synthetic yield (lbs/acre) from radiation, precipitation and
    soil pH of each enriched occurrence, bucketed in 5 equal bins."""
    spec = FX.raster_spec(spark, sf_dir)
    j = R.nearest_cell_join(C.clean_occurrences(FX.occ(spark, sf_dir)), FX.cube(spark, sf_dir), spec, days=ST.DAYS)
    j = EN.fill_soil_ph(j, FX.soil(spark), spec)
    return RP.yield_score(j).select("gbifID", "yield_lbs_acre", "yield_bucket")
