"""Profiling, validation and fingerprint aggregates.

Everything is one pass with many conditional aggregates (partial
aggregation map-side), never an action per rule.  Wide results are turned
into rows with ``stack``/``explode`` so they stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habiflow.session import cut_lineage

LAT, LON = "decimalLatitude", "decimalLongitude"

# --- fixed values that must equal the reference's (do not edit) ----------
YEAR_RANGE = (1800, 2025)
MONTH_RANGE = (1, 12)
DAY_RANGE = (1, 31)
LAT_RANGE = (-90, 90)
LON_RANGE = (-180, 180)
# --------------------------------------------------------------------------


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(field, value, n) for several columns in one shuffle; nulls dropped.

    Each row is exploded into (column, value) pairs and grouped once, so a
    hot value is combined map-side instead of landing whole in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return (df.select(F.explode(pairs).alias("p")).select("p.field", "p.value")
              .filter(F.col("value").isNotNull())
              .groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")))


def distinct_before_after(df: DataFrame, col: str, cleaned: Column) -> DataFrame:
    """Distinct counts of a column before and after a cleaning expression."""
    return df.agg(F.count_distinct(F.col(col)).alias("distinct_before"),
                  F.count_distinct(cleaned).alias("distinct_after"))


def step_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """D3: rows surviving each cumulative step, in one pass.

    ``steps`` is an ordered list of (name, keep-predicate).  Output rows:
    (step_order, step, rows_in, rows_out, retention_pct).
    """
    aggs = [F.count(F.lit(1)).alias("s0")]
    cond = F.lit(True)
    for i, (_, pred) in enumerate(steps, start=1):
        cond = cond & F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(cond).alias(f"s{i}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("step_order"), F.lit(name).alias("step"),
                              F.col(f"s{i - 1}").alias("rows_in"), F.col(f"s{i}").alias("rows_out"))
                     for i, (name, _) in enumerate(steps, start=1)])
    out = wide.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("retention_pct", F.round(
        F.when(F.col("rows_in") > 0, F.col("rows_out") * 100.0 / F.col("rows_in")), 6))


def cleaning_summary(original: DataFrame, cleaned: DataFrame, year_col: str = "year") -> DataFrame:
    """Original, cleaned, removed, retention %, year min/max/span."""
    a = original.agg(F.count(F.lit(1)).alias("original_count"))
    b = cleaned.agg(F.count(F.lit(1)).alias("cleaned_count"),
                    F.min(year_col).cast("int").alias("year_min"),
                    F.max(year_col).cast("int").alias("year_max"))
    return (a.crossJoin(b)
            .withColumn("removed_count", F.col("original_count") - F.col("cleaned_count"))
            .withColumn("retention_pct", F.round(F.col("cleaned_count") * 100.0 / F.col("original_count"), 6))
            .withColumn("year_span", F.col("year_max") - F.col("year_min")))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, nulls, non_nulls) for every column, one pass."""
    cols = list(cols or df.columns)
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count(F.col(c)).alias(f"__c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                              (F.col("__n") - F.col(f"__c{i}")).alias("nulls"),
                              F.col(f"__c{i}").alias("non_nulls")) for i, c in enumerate(cols)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def all_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Names of columns with no non-null value (warning list)."""
    return null_profile(df, cols).filter(F.col("non_nulls") == 0).select("column")


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``field`` (place in ``cols``), ``v``, ``n``: how often each number occurs, in one scan; nulls and NaN dropped.

    Counts are combined before the shuffle, so a value that most rows hold is
    one row a task.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("field"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    return (df.select(F.inline(pairs)).filter(F.col("v").isNotNull() & ~F.isnan("v"))
            .groupBy("field", (F.col("v") + F.lit(0.0)).alias("v")).agg(F.count(F.lit(1)).alias("n")))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``describe`` semantics) of several columns together.

    The different values of all columns, with their counts, are cut into ranges
    by (column, value) once.  Counts a range give each range's first rank; only
    the ranges that hold a wanted rank are then ranked value by value.  Output:
    ``field`` and ``q_<pct>``; a column without numbers has no row.
    """
    freq = cut_lineage(value_frequencies(df, cols))
    # stored with its range's number, so that every later use sees the same cuts
    ranged = cut_lineage(freq.repartitionByRange("field", "v").withColumn("pid", F.spark_partition_id()))
    earlier = Window.partitionBy("field").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    spans = (ranged.groupBy("field", "pid").agg(F.sum("n").alias("cnt"))
             .withColumn("start", F.coalesce(F.sum("cnt").over(earlier), F.lit(0)))
             .withColumn("total", F.sum("cnt").over(Window.partitionBy("field"))))
    wants = []
    for i, p in enumerate(probs):
        h = (F.col("total") - 1) * F.lit(float(p))
        for side in (0, 1):
            wants.append(F.struct(F.lit(i).alias("q"), F.lit(side).alias("side"), (h - F.floor(h)).alias("frac"),
                                  F.least(F.floor(h) + side, F.col("total") - 1).alias("rank")))
    targets = (spans.select("field", "pid", "start", "cnt", F.explode(F.array(*wants)).alias("w"))
               .select("field", "pid", "start", "cnt", "w.*").filter("rank >= start AND rank < start + cnt"))
    running = Window.partitionBy("field", "pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    needed = targets.select("field", "pid", "start").distinct()
    ranked = (ranged.join(needed, ["field", "pid"])
              .withColumn("upto", F.col("start") + F.sum("n").over(running)))
    picked = (ranked.join(targets.select("field", "pid", "q", "side", "frac", "rank"), ["field", "pid"])
              .filter("rank < upto AND rank >= upto - n"))
    lo, hi = F.max(F.when(F.col("side") == 0, F.col("v"))), F.max(F.when(F.col("side") == 1, F.col("v")))
    one = (picked.groupBy("field", "q").agg(lo.alias("lo"), hi.alias("hi"), F.max("frac").alias("frac"))
           .withColumn("value", F.when(F.col("lo") == F.col("hi"), F.col("lo"))
                       .otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac"))))
    return one.groupBy("field").agg(*[F.max(F.when(F.col("q") == i, F.col("value"))).alias(f"q_{int(round(p * 100))}")
                                      for i, p in enumerate(probs)])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """``quantiles`` of one column: one row with columns ``q_<pct>``, null without numbers."""
    q = quantiles(df, [col], probs).drop("field")
    return q.agg(*[F.max(c).alias(c) for c in q.columns])


def numeric_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear) and max of several columns, a row each.

    Two scans for any number of columns: one aggregate and one count of values.
    NaN is missing, as null is.
    """
    aggs = []
    for i, c in enumerate(cols):
        v = F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
        aggs.append(F.struct(F.lit(i).alias("field"), F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                             F.stddev_samp(v).alias("std"), F.min(v).cast("double").alias("min"),
                             F.max(v).cast("double").alias("max")))
    base = df.agg(F.array(*aggs).alias("s")).select(F.inline("s"))
    q = quantiles(df, cols, (0.25, 0.5, 0.75))
    return base.join(q, "field", "left").select("count", "mean", "std", "min", F.col("q_25").alias("p25"), F.col("q_50").alias("p50"),
                                                F.col("q_75").alias("p75"), "max", "column")


def describe(df: DataFrame, col: str) -> DataFrame:
    """``numeric_describe`` of one column."""
    return numeric_describe(df, [col]).drop("column")


# ------------------------------------------------------------ validation ----

def validation_report(df: DataFrame, expected: Sequence[str] = (), temporal_required: bool = True,
                      lat: str = LAT, lon: str = LON) -> DataFrame:
    """Rule table ``(ord, rule, violations)`` from one aggregate pass.

    Order follows the reference: empty frame; missing expected columns;
    missing y/m/d columns; for year, month, day: nulls then range; latitude
    and longitude range (null coordinates do not fail).  Schema-level rules
    are decided on the driver from the schema (no data access).  With
    ``temporal_required=False`` (scoring input) y/m/d rules are skipped when
    the columns are absent.
    """
    cols = set(df.columns)
    missing_expected = [c for c in expected if c not in cols]
    missing_temporal = [c for c in ("year", "month", "day") if c not in cols]
    rules: list[tuple[str, Column]] = [("non_empty", F.lit(None))]
    static: dict[str, int] = {
        "expected_columns": len(missing_expected),
        "temporal_columns": len(missing_temporal) if temporal_required else 0,
    }
    checks: list[tuple[str, Column]] = []
    ranges = {"year": YEAR_RANGE, "month": MONTH_RANGE, "day": DAY_RANGE}
    for c in ("year", "month", "day"):
        if c in cols:
            checks.append((f"{c}_nulls", F.col(c).isNull()))
            lo, hi = ranges[c]
            checks.append((f"{c}_range", (F.col(c) < lo) | (F.col(c) > hi)))
    for c, (lo, hi) in ((lat, LAT_RANGE), (lon, LON_RANGE)):
        if c in cols:
            checks.append((f"{c}_range", (F.col(c) < lo) | (F.col(c) > hi)))
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.coalesce(p, F.lit(False))).alias(f"__v{i}") for i, (_, p) in enumerate(checks)])
    entries = [F.struct(F.lit(1).alias("ord"), F.lit("non_empty").alias("rule"),
                        F.when(F.col("__n") == 0, 1).otherwise(0).cast("bigint").alias("violations")),
               F.struct(F.lit(2).alias("ord"), F.lit("expected_columns").alias("rule"),
                        F.lit(static["expected_columns"]).cast("bigint").alias("violations")),
               F.struct(F.lit(3).alias("ord"), F.lit("temporal_columns").alias("rule"),
                        F.lit(static["temporal_columns"]).cast("bigint").alias("violations"))]
    for i, (name, _) in enumerate(checks):
        entries.append(F.struct(F.lit(4 + i).alias("ord"), F.lit(name).alias("rule"),
                                F.col(f"__v{i}").cast("bigint").alias("violations")))
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def validation_verdict(report: DataFrame) -> DataFrame:
    """D8 verdict: passed = every rule has zero violations; first failing rule."""
    return report.agg(
        F.bool_and(F.col("violations") == 0).alias("passed"),
        F.min_by(F.when(F.col("violations") > 0, F.col("rule")),
                 F.when(F.col("violations") > 0, F.col("ord"))).alias("first_failure"))


# ----------------------------------------------------------- fingerprint ----

def fingerprint(df: DataFrame, cols: Sequence[str] | None = None, buckets: int = 256) -> DataFrame:
    """Order-insensitive dataset fingerprint.

    Per row ``md5`` of the '|'-joined text of the columns, in which '\\' and
    '|' are escaped by '\\' (null -> '\\N', which no escaped text is);
    rows are summed per hash bucket (first two hex digits) as 32-bit
    integers; the fingerprint is the md5 of the ordered bucket list.  The
    result does not depend on row order or partitioning.
    """
    cols = list(cols or df.columns)
    field = lambda c: F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    txt = F.concat_ws("|", *[F.coalesce(field(c), F.lit("\\N")) for c in cols])
    h = F.md5(txt)
    per_row = df.select(F.conv(F.substring(h, 1, 2), 16, 10).cast("int").alias("b"),
                        F.conv(F.substring(h, 3, 8), 16, 10).cast("bigint").alias("x"))
    per_bucket = per_row.groupBy("b").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum("x").cast("decimal(38,0)").alias("s"))
    # at most `buckets` rows reach this last aggregate
    line = F.concat_ws(":", F.col("b").cast("string"), F.col("n").cast("string"),
                       F.col("s").cast("string"))
    return per_bucket.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", line.alias("t")))),
                                       lambda e: e["t"]), ",")).alias("fingerprint"))
