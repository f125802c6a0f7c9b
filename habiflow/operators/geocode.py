"""Geocoding as joins.

Instead of one remote lookup per row, every row that lacks coordinates
emits its ordered list of candidate place strings; each distinct set of place
columns is looked up in a gazetteer table once and keeps the match with the
lowest candidate position (``min_by``), i.e. "first strategy that resolves
wins".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.operators.dictionary import dictionary_join
from habiflow.session import cut_lineage

LAT, LON = "decimalLatitude", "decimalLongitude"
# all that the candidates of a row depend on
PLACE_COLUMNS = ("locality", "verbatimLocality", "municipality", "county", "stateProvince", "countryCode", "landmark",
                 "municipality_landmark")


def _usable(c: str, sentinels, min_len: int) -> Column:
    t = F.trim(F.col(c))
    return F.coalesce(~F.lower(t).isin(*sentinels) & (F.length(t) > min_len), F.lit(False))


def _cand(pos: int, kind: str, text: Column, cond: Column | None = None, llm: bool = False) -> Column:
    t = text if cond is None else F.when(cond, text)
    return F.struct(F.lit(pos).alias("pos"), F.lit(kind).alias("kind"), t.alias("text"),
                    F.lit(llm).alias("llm"))


def candidates(df: DataFrame, landmark: str | None = "landmark",
               municipality_landmark: str | None = "municipality_landmark") -> Column:
    """Ordered candidate list of one row (Appendix A.C5 of the survey).

    Landmark positions (6, 7, 10, 11) are used only when the optional
    landmark columns exist (the cleaned answers of an external extractor,
    see :func:`habiflow.functions.first_clean_line`).
    """
    cols = set(df.columns)
    loc_ok = _usable("locality", H.LOCALITY_SENTINELS, 5)
    verb_ok = _usable("verbatimLocality", H.VERBATIM_SENTINELS, 5) if "verbatimLocality" in cols else F.lit(False)
    mun_t = F.trim(F.col("municipality"))
    mun_ok = F.coalesce(~F.lower(mun_t).isin(*H.MUNICIPALITY_SENTINELS) & (F.length(mun_t) > 2), F.lit(False))
    verbatim = F.trim(F.col("verbatimLocality")) if "verbatimLocality" in cols else F.lit(None).cast("string")
    out = [
        _cand(1, "gaz", H.concat_known("locality", "municipality", "county", "stateProvince", "countryCode")),
        _cand(2, "gaz", verbatim, verb_ok),
        _cand(3, "gaz", F.trim(F.col("locality")), loc_ok),
        _cand(4, "gaz", H.concat_known(verbatim, "county", "stateProvince"), verb_ok),
        _cand(5, "gaz", H.concat_known("locality", "county", "stateProvince"), F.col("locality").isNotNull()),
    ]
    if landmark is not None and landmark in cols:
        src_ok = loc_ok | (F.col("locality").isNull() & _usable(
            "verbatimLocality", H.VERBATIM_LANDMARK_SENTINELS, 5) if "verbatimLocality" in cols else loc_ok)
        lm = F.col(landmark)
        out += [_cand(6, "gaz", H.concat_nonnull(lm, *[F.when(F.lower(F.trim(F.col(c))) != "unknown", F.col(c))
                                                     for c in ("county", "stateProvince", "countryCode")]),
                      src_ok & lm.isNotNull(), llm=True),
                _cand(7, "gaz", lm, src_ok, llm=True)]
    out += [
        _cand(8, "gaz", mun_t, mun_ok),
        _cand(9, "gaz", H.concat_known(mun_t, "county", "stateProvince", "countryCode"), mun_ok),
    ]
    if municipality_landmark is not None and municipality_landmark in cols:
        long_mun = mun_ok & (F.length(mun_t) > 20)
        ml = F.col(municipality_landmark)
        out += [_cand(10, "gaz", H.concat_nonnull(ml, *[F.when(F.lower(F.trim(F.col(c))) != "unknown", F.col(c))
                                                      for c in ("county", "stateProvince", "countryCode")]),
                      long_mun & ml.isNotNull(), llm=True),
                _cand(11, "gaz", ml, long_mun, llm=True)]
    out += [
        _cand(12, "locality", F.col("locality")),
        _cand(13, "municipality", F.col("municipality")),
        _cand(14, "gaz", H.concat_known("county", "stateProvince", "countryCode"),
              F.col("county").isNotNull() & F.col("stateProvince").isNotNull()),
    ]
    return F.array(*out)


def lookup_table(gazetteer: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Unified lookup: (kind, key, lat, lon).  Gazetteer keys are normalised
    (lower/trim); manual keys are exact strings per kind."""
    g = gazetteer.select(F.lit("gaz").alias("kind"), F.lower(F.trim("place_key")).alias("key"), "lat", "lon")
    if manual is None:
        return g
    m = manual.select("kind", F.col("place").alias("key"), "lat", "lon")
    return g.unionByName(m)


def geocode_cascade(df: DataFrame, gazetteer: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Fill missing coordinates from the first resolving candidate.

    Output: input columns with lat/lon filled where resolved, plus
    ``geocode_pos`` (winning candidate position) and ``used_llm``.  Rows that
    already have both coordinates pass unchanged (flag false).

    Rows that lack coordinates are reduced to their different sets of place
    columns; the candidates of each set are looked up in the dictionary of
    (kind, key), ``min_by`` takes the first hit, and the sets' answers go back
    to the rows.  Both lookups are :func:`dictionary_join`, so neither a
    sentinel that most rows carry nor a place that most rows share is a task
    of its own.
    """
    has = F.col(LAT).isNotNull() & F.col(LON).isNotNull()
    columns = [c for c in PLACE_COLUMNS if c in df.columns]
    place = F.sha2(F.to_json(F.struct(*columns)), 256)  # to_json leaves nulls out, so null and '' differ
    x = df.withColumn("__place", F.when(~has, place))
    places = (x.filter(F.col("__place").isNotNull()).groupBy("__place")
              .agg(*[F.first(c).alias(c) for c in columns]))
    cands = (places.select("__place", F.explode(candidates(places)).alias("c"))
             .select("__place", "c.pos", "c.kind", "c.llm",
                     F.when(F.col("c.kind") == "gaz", F.lower(F.trim("c.text"))).otherwise(F.col("c.text")).alias("key"))
             .filter(F.col("key").isNotNull() & (F.length("key") > 0))
             .select("__place", "pos", "llm", F.concat_ws(":", "kind", "key").alias("__key")))
    table = (lookup_table(gazetteer, manual).groupBy(F.concat_ws(":", "kind", "key").alias("__key"))
             .agg(F.min(F.struct("lat", "lon")).alias("at")))
    hits = dictionary_join(cut_lineage(cands), table, "__key").filter(F.col("at").isNotNull())
    best = hits.groupBy("__place").agg(F.min_by(F.struct("at", "pos", "llm"), F.col("pos")).alias("b"))
    out = dictionary_join(x, cut_lineage(best), "__place")
    return (out.withColumn("used_llm", F.when(has, F.lit(False)).otherwise(F.coalesce(F.col("b.llm"), F.lit(False))))
               .withColumn("geocode_pos", F.when(~has, F.col("b.pos")))
               .withColumns({LAT: F.when(has, F.col(LAT)).otherwise(F.col("b.at.lat")),
                             LON: F.when(has, F.col(LON)).otherwise(F.col("b.at.lon"))})
               .drop("b", "__place"))


def apply_manual(df: DataFrame, manual: DataFrame) -> DataFrame:
    """Rows without coordinates: exact locality map, then municipality map.

    Only those rows take part in the lookups; a place that many of them name
    is looked up apart (:func:`dictionary_join`).
    """
    missing = F.col(LAT).isNull() | F.col(LON).isNull()
    x = df
    for kind in ("locality", "municipality"):
        table = (manual.filter(F.col("kind") == kind).groupBy(F.col("place").alias(f"__{kind}"))
                 .agg(F.min(F.struct("lat", "lon")).alias(f"__at_{kind}")))
        x = dictionary_join(x.withColumn(f"__{kind}", F.when(missing, F.col(kind))), table, f"__{kind}")
    found = lambda c: F.coalesce(F.col(f"__at_locality.{c}"), F.col(f"__at_municipality.{c}"))
    return (x.withColumns({LAT: F.when(missing, found("lat")).otherwise(F.col(LAT)),
                           LON: F.when(missing, found("lon")).otherwise(F.col(LON))})
             .drop(*[f"__{p}{kind}" for kind in ("locality", "municipality") for p in ("", "at_")]))


def geocode_summary(df: DataFrame) -> DataFrame:
    """Total, geocoded, failed, success %, flagged count and %."""
    ok = F.col(LAT).isNotNull() & F.col(LON).isNotNull()
    s = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("geocoded"),
               F.count_if(F.coalesce(F.col("used_llm"), F.lit(False))).alias("flagged"))
    return (s.withColumn("failed", F.col("total") - F.col("geocoded"))
             .withColumn("success_pct", F.round(F.col("geocoded") * 100.0 / F.col("total"), 6))
             .withColumn("flagged_pct", F.round(F.col("flagged") * 100.0 / F.col("total"), 6)))
