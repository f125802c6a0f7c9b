"""Gridded-cube operators.

A raster is a long table: one row per (time, lat, lon) cell with integer
axis indices ``itime, ilat, ilon`` next to the coordinate values and the
variables.  Axes are regular (origin, step, size), so snapping a point to
the nearest cell is arithmetic on each axis and the raster join is an
equi-join on three integer keys: a hash/sort-merge join that partitions by
cell, not a nearest-neighbour search.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habiflow import functions as H

SECONDS_PER_DAY = 86400
MANY_BLOCKS = 500   # time blocks that a filter lists one by one
FEW_CELLS = 100_000   # cells that a join may broadcast (some 10 MB)


@dataclass(frozen=True)
class Axis:
    """Regular axis ``value(i) = origin + step * i`` for ``i in [0, size)``.

    ``step`` may be negative (latitude stored north to south).
    """
    name: str
    origin: float
    step: float
    size: int

    @property
    def lo(self) -> float:
        return min(self.origin, self.origin + self.step * (self.size - 1))

    @property
    def hi(self) -> float:
        return max(self.origin, self.origin + self.step * (self.size - 1))

    def index(self, x: Column) -> Column:
        """Index of the nearest axis value; exact ties go to the lower index.

        ``ceil(pos - 0.5)`` rounds half down, which is the first-index argmin
        for either sign of ``step``.
        """
        pos = (x - F.lit(self.origin)) / F.lit(self.step)
        i = F.ceil(pos - F.lit(0.5)).cast("int")
        return F.least(F.greatest(i, F.lit(0)), F.lit(self.size - 1))

    def value(self, i: Column) -> Column:
        return F.lit(self.origin) + F.lit(self.step) * i

    def sql_index(self, x: str) -> str:
        return (f"LEAST(GREATEST(CAST(ceil(({x} - ({self.origin})) / ({self.step}) - 0.5) AS INTEGER), 0), "
                f"{self.size - 1})")


@dataclass(frozen=True)
class RasterSpec:
    """Geometry of a daily/weekly cube: two regular spatial axes and a time axis."""
    lat: Axis
    lon: Axis
    time_origin: str            # 'yyyy-MM-dd'
    time_step_days: int
    time_size: int
    variables: tuple[str, ...] = field(default_factory=tuple)
    time_block: int = 52        # time steps per ``tblock`` partition

    @property
    def time_max(self) -> Column:
        return F.date_add(F.lit(self.time_origin).cast("date"),
                          (self.time_size - 1) * self.time_step_days)

    @property
    def time_min(self) -> Column:
        return F.lit(self.time_origin).cast("date")

    def time_index(self, ts: Column) -> Column:
        """Nearest time step of a timestamp (first index on ties)."""
        origin = F.unix_seconds(F.lit(self.time_origin).cast("timestamp"))
        pos = (F.unix_seconds(ts.cast("timestamp")) - origin) / F.lit(
            float(self.time_step_days * SECONDS_PER_DAY))
        i = F.ceil(pos - F.lit(0.5)).cast("int")
        return F.least(F.greatest(i, F.lit(0)), F.lit(self.time_size - 1))

    def time_value(self, i: Column) -> Column:
        return F.date_add(F.lit(self.time_origin).cast("date"), i * self.time_step_days)

    def sql_time_index(self, ts: str) -> str:
        step = float(self.time_step_days * SECONDS_PER_DAY)
        return (f"LEAST(GREATEST(CAST(ceil((epoch(CAST({ts} AS TIMESTAMP)) - "
                f"epoch(TIMESTAMP '{self.time_origin} 00:00:00')) / {step} - 0.5) AS INTEGER), 0), "
                f"{self.time_size - 1})")


def index_raster(raster: DataFrame, spec: RasterSpec) -> DataFrame:
    """Add ``itime, ilat, ilon`` to a raster that only carries values."""
    out = raster
    if "ilat" not in raster.columns:
        out = out.withColumn("ilat", spec.lat.index(F.col("lat")))
    if "ilon" not in raster.columns:
        out = out.withColumn("ilon", spec.lon.index(F.col("lon")))
    if "itime" not in raster.columns:
        out = out.withColumn("itime", spec.time_index(F.col("time")))
    return out


def clean_raster(raster: DataFrame, spec: RasterSpec) -> DataFrame:
    """NaN -> NULL on every variable (T15), done once at the source."""
    return raster.select(*[H.nan_to_null(c).alias(c) if c in spec.variables else F.col(c)
                           for c in raster.columns])


# ---------------------------------------------------------------- joins ----

def effective_time(df: DataFrame, spec: RasterSpec, datetime_col: str | None = "datetime",
                   target_date: str | None = None) -> Column:
    """Date used for the time snap.

    fixed ``target_date``: clamped to the last raster date when outside the
    range; otherwise the row's datetime; without a datetime column: the last
    raster date.
    """
    last = spec.time_max.cast("timestamp")
    if target_date is not None:
        t = F.lit(target_date).cast("timestamp")
        inside = (t >= spec.time_min.cast("timestamp")) & (t <= last)
        return F.when(inside, t).otherwise(last)
    if datetime_col is not None and datetime_col in df.columns:
        return F.col(datetime_col).cast("timestamp")
    return last


def nearest_cell_join(points: DataFrame, raster: DataFrame, spec: RasterSpec,
                      lat_col: str = "decimalLatitude", lon_col: str = "decimalLongitude",
                      datetime_col: str | None = "datetime", target_date: str | None = None,
                      prefix: str = "gridmet_", days: tuple[str, str] | None = None) -> DataFrame:
    """Nearest-cell raster join (C1 with C2).

    1. effective date per row (see :func:`effective_time`);
    2. keep rows whose lat/lon lie inside the raster extent (inclusive) and,
       when the row's own datetime is used, whose date lies in the time range;
    3. snap each axis independently (first index on ties);
    4. inner equi-join on (itime, ilat, ilon); rows whose cell has any null or
       NaN variable are dropped;
    5. output = input columns + ``{prefix}lat/lon/date`` + the variables.

    Plan: an equi-join on the three integer cell keys.  A raster with a
    ``tblock`` partition column (``spec.time_block`` steps each) is read only
    in the blocks that the points hit; finding those is one pass over the
    points.  With ``days``, the first and the last date the rows can have, there
    is no such pass (streams have none): they bound what is read.  The cells of
    few blocks or days are broadcast, as the spec tells their number; otherwise
    both sides are shuffled and AQE splits hot cells, whatever size the planner
    assumes for a raster that is derived while it is read.
    """
    lat, lon = F.col(lat_col), F.col(lon_col)
    t = effective_time(points, spec, datetime_col, target_date)
    use_row_time = target_date is None and datetime_col is not None and datetime_col in points.columns
    cond = (lat.between(spec.lat.lo, spec.lat.hi) & lon.between(spec.lon.lo, spec.lon.hi))
    if use_row_time:
        cond = cond & t.between(spec.time_min.cast("timestamp"), spec.time_max.cast("timestamp"))
    keyed = points.filter(cond).select("*", spec.lat.index(lat).alias("__ilat"),
                                       spec.lon.index(lon).alias("__ilon"), spec.time_index(t).alias("__itime"))
    vars_ = list(spec.variables)
    cells = clean_raster(index_raster(raster, spec), spec).select(
        F.col("itime").alias("__itime"), F.col("ilat").alias("__ilat"), F.col("ilon").alias("__ilon"),
        *[F.col(v) for v in vars_], *([F.col("tblock")] if "tblock" in raster.columns else []))
    full = F.lit(True)
    for v in vars_:
        full = full & F.col(v).isNotNull()
    cells = cells.filter(full)
    keys = ["__itime", "__ilat", "__ilon"]
    n_cells = None
    bounded = days is not None and use_row_time
    if bounded:
        first = spec.time_index(F.lit(days[0]).cast("timestamp"))
        last = spec.time_index(F.date_add(F.lit(days[1]).cast("date"), 1).cast("timestamp"))
        cells = cells.filter(F.col("__itime").between(first, last))
        if "tblock" in raster.columns:
            cells = cells.filter(F.col("tblock").between((first / spec.time_block).cast("int"), (last / spec.time_block).cast("int")))
    if "tblock" in raster.columns:
        # only the time blocks some point falls into are read: a filter on the
        # partition column, by their list or, of a long axis, by their range;
        # known days bound them without a pass over the points
        if bounded and not points.isStreaming:
            steps = (date.fromisoformat(days[1]) - date.fromisoformat(days[0])).days // spec.time_step_days + 3
            n_cells = min(steps, spec.time_size) * spec.lat.size * spec.lon.size
        elif not points.isStreaming:
            hit = keyed.select((F.col("__itime") / spec.time_block).cast("int").alias("b")).filter("b IS NOT NULL").distinct()
            blocks = sorted(r["b"] for r in hit.limit(MANY_BLOCKS + 1).collect())
            if len(blocks) > MANY_BLOCKS:
                ends = keyed.agg(F.min("__itime").alias("lo"), F.max("__itime").alias("hi")).first()
                cells = cells.filter(F.col("tblock").between(ends["lo"] // spec.time_block, ends["hi"] // spec.time_block))
            else:
                cells = cells.filter(F.col("tblock").isin(blocks))
                n_cells = len(blocks) * spec.time_block * spec.lat.size * spec.lon.size
        cells = cells.drop("tblock")
    # drop input columns that the join would duplicate (re-enrichment)
    clash = [c for c in vars_ + [f"{prefix}lat", f"{prefix}lon", f"{prefix}date"] if c in points.columns]
    keyed = keyed.drop(*clash)
    j = keyed.join(cells.hint("broadcast" if n_cells is not None and n_cells <= FEW_CELLS else "merge"), keys, "inner")
    return j.select(*[c for c in keyed.columns if not c.startswith("__")],
                    spec.lat.value(F.col("__ilat")).alias(f"{prefix}lat"),
                    spec.lon.value(F.col("__ilon")).alias(f"{prefix}lon"),
                    spec.time_value(F.col("__itime")).alias(f"{prefix}date"), *vars_)


def held_days(raster: DataFrame, spec: RasterSpec, days: tuple[str, str]) -> DataFrame:
    """The cells of the time steps between two dates, kept for the many joins of a stream.

    Dealt and sorted by cell key once, as :func:`nearest_cell_join` asks for, so
    a micro-batch shuffles its own points only.  Kept by the executors, on disk
    where memory is short; as many rows as the days have.  The caller unpersists.
    """
    first = spec.time_index(F.lit(days[0]).cast("timestamp"))
    last = spec.time_index(F.date_add(F.lit(days[1]).cast("date"), 1).cast("timestamp"))
    r = index_raster(raster, spec).filter(F.col("itime").between(first, last))
    if "tblock" in raster.columns:
        r = r.filter(F.col("tblock").between((first / spec.time_block).cast("int"), (last / spec.time_block).cast("int")))
    keys = ["itime", "ilat", "ilon"]
    n = int(raster.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return r.select(*keys, *spec.variables).repartition(n, *keys).sortWithinPartitions(*keys).persist()


def snap_cells(points: DataFrame, spec: RasterSpec, lat_col: str = "decimalLatitude",
               lon_col: str = "decimalLongitude") -> DataFrame:
    """Attach spatial cell indices (``ilat``, ``ilon``) for static lookups."""
    return (points.withColumn("ilat", spec.lat.index(F.col(lat_col)))
                  .withColumn("ilon", spec.lon.index(F.col(lon_col))))


def select_nearest(raster: DataFrame, spec: RasterSpec, lat: float | None = None,
                   lon: float | None = None, day: str | None = None) -> DataFrame:
    """Label selection with ``method='nearest'`` on any subset of axes.

    Scalars are snapped on the driver-free column path (``lit``); the filter
    is on integer index columns, so it prunes a raster partitioned by them.
    """
    r = index_raster(raster, spec)
    cond = F.lit(True)
    if lat is not None:
        cond = cond & (F.col("ilat") == spec.lat.index(F.lit(float(lat))))
    if lon is not None:
        cond = cond & (F.col("ilon") == spec.lon.index(F.lit(float(lon))))
    if day is not None:
        cond = cond & (F.col("itime") == spec.time_index(F.lit(day).cast("timestamp")))
    return r.filter(cond)


def slice_time(raster: DataFrame, start: str | None = None, end: str | None = None,
               month: str | None = None, spec: RasterSpec | None = None) -> DataFrame:
    """Label / partial-date slices (B27): inclusive ``[start, end]`` or a month
    given as 'yyyy-MM'.

    With ``spec`` and a ``tblock`` partition column, the labels become a range
    of blocks, so only those partitions are read.
    """
    if month is not None:
        first = date.fromisoformat(f"{month}-01")
        last = (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
        start = max(x for x in (start, first.isoformat()) if x is not None)
        end = min(x for x in (end, last.isoformat()) if x is not None)
    c = F.lit(True)
    if start is not None:
        c = c & (F.col("time") >= F.lit(start).cast("date"))
    if end is not None:
        c = c & (F.col("time") <= F.lit(end).cast("date"))
    if spec is not None and "tblock" in raster.columns:
        width = spec.time_step_days * spec.time_block
        block = lambda day: (date.fromisoformat(day) - date.fromisoformat(spec.time_origin)).days // width
        if start is not None:
            c = c & (F.col("tblock") >= block(start))
        if end is not None:
            c = c & (F.col("tblock") <= block(end))
    return raster.filter(c)


def latest_slice(raster: DataFrame) -> DataFrame:
    """The rows of the last time step.

    The last block comes from the values of the partition column, for which no
    data column is read; only that partition is then read.
    """
    if "tblock" in raster.columns:
        last = raster.agg(F.max("tblock")).first()[0]  # one number
        raster = raster.filter(F.col("tblock") == F.lit(last))
    latest = raster.agg(F.max("time").alias("__t"))
    return raster.join(F.broadcast(latest), F.col("time") == F.col("__t")).drop("__t")  # one row


def range_of(v: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` are at most ``v``, by halving."""
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))] or [1]
    at = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    # a place behind the last cut is null and no step
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda n, s: n + F.when(F.get(at, n + s - 1) <= v, s).otherwise(0))


def nearest_on_axis(labels: DataFrame, label: str, axis: DataFrame, value: str, index: str, buckets: int = 1024) -> DataFrame:
    """C12 for many labels and an axis of any spacing: ``label, index, value`` for each different label.

    Labels and breakpoints are merged in order; a label takes the breakpoint
    before it or the one after, whichever is nearer, and of two as near the
    lower index.  The order is cut at approximate quantiles into ranges that are
    sorted apart, once up and once down, so each frame only grows; the
    last breakpoint before a range and the first after it come from a table of
    a row a range.  A null label, or an empty axis, gives null.
    """
    points = axis.select(F.col(value).cast("double").alias("v"), F.col(index).alias("i")).filter("v IS NOT NULL")
    wanted = labels.select(F.col(label).cast("double").alias("v"))
    shares = [k / buckets for k in range(1, buckets)] or [0.5]
    known = points.select("v", F.lit(1).alias("p")).unionByName(wanted.withColumn("p", F.lit(None).cast("int")))
    known = known.agg(F.count("p").alias("n"), F.percentile_approx("v", shares).alias("cuts")).first()  # a number a range
    points = points.groupBy("v").agg(F.min("i").alias("i"))
    wanted = wanted.distinct()
    if not known["n"]:
        return wanted.select(F.col("v").alias(label), F.lit(None).cast(axis.schema[index].dataType).alias(index),
                             F.lit(None).cast("double").alias(value))
    cuts = sorted(set(known["cuts"]))
    bucket = range_of(F.col("v"), cuts).alias("b")
    points, wanted = points.select(bucket, "v", "i"), wanted.select(bucket, "v")
    at = F.struct("v", "i")
    edges = points.groupBy("b").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    up, down = Window.orderBy("b"), Window.orderBy(F.desc("b"))  # a row a range
    others = (Window.unboundedPreceding, -1)
    edges = (labels.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("b")).join(edges, "b", "left")
             .select("b", F.max("last").over(up.rowsBetween(*others)).alias("before"),
                     F.min("first").over(down.rowsBetween(*others)).alias("after")))
    both = points.select("b", "v", F.struct("v", "i").alias("p")).unionByName(wanted.withColumn("p", F.lit(None).cast(points.select(at).schema[0].dataType)))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    rising, falling = (Window.partitionBy("b").orderBy(o).rangeBetween(*so_far) for o in (F.asc("v"), F.desc("v")))
    both = both.select("b", "v", "p", F.last("p", True).over(rising).alias("down"), F.last("p", True).over(falling).alias("up"))
    found = (both.filter(F.col("p").isNull()).join(F.broadcast(edges), "b", "left")  # ``buckets`` rows
             .select("v", F.coalesce("down", "before").alias("down"), F.coalesce("up", "after").alias("up")))
    near = [F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.v") - F.col("v")).alias("d"), F.col(f"{c}.i").alias("i"),
                                                 F.col(f"{c}.v").alias("x"))) for c in ("down", "up")]
    best = F.when(F.col("v").isNotNull(), F.least(*near))
    return found.select(F.col("v").alias(label), best["i"].alias(index), best["x"].alias(value))


def slice_index(raster: DataFrame, **ranges: tuple[int, int]) -> DataFrame:
    """Position selection (``isel``): half-open index ranges per axis index column."""
    c = F.lit(True)
    for name, (a, b) in ranges.items():
        c = c & (F.col(name) >= a) & (F.col(name) < b)
    return raster.filter(c)


def extent_filter(points: DataFrame, bounds: DataFrame, lat_col: str = "decimalLatitude",
                  lon_col: str = "decimalLongitude") -> DataFrame:
    """Data-driven bounds (B13): ``bounds`` is a one-row frame of
    lat_min/lat_max/lon_min/lon_max (an aggregate); joined as a one-row
    broadcast and applied as a filter."""
    b = F.broadcast(bounds.select("lat_min", "lat_max", "lon_min", "lon_max"))
    return (points.crossJoin(b)
            .filter(F.col(lat_col).between(F.col("lat_min"), F.col("lat_max"))
                    & F.col(lon_col).between(F.col("lon_min"), F.col("lon_max")))
            .drop("lat_min", "lat_max", "lon_min", "lon_max"))


def raster_extent(raster: DataFrame) -> DataFrame:
    """One-row extent of a raster: min/max of each coordinate and axis sizes."""
    return raster.agg(F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
                      F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
                      F.min("time").alias("time_min"), F.max("time").alias("time_max"),
                      F.count_distinct("lat").alias("n_lat"), F.count_distinct("lon").alias("n_lon"),
                      F.count_distinct("time").alias("n_time"))


def axes_extent(raster: DataFrame) -> DataFrame:
    """D10 of a gridded cube: :func:`raster_extent` from the sets of axis values.

    One aggregation without expanding the rows for each distinct count; a set
    holds an axis, which is what a task combines and sends.
    """
    sets = raster.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in ("lat", "lon", "time")])
    ends = [f(c).alias(f"{c}_{n}") for c in ("lat", "lon", "time") for n, f in (("min", F.array_min), ("max", F.array_max))]
    return sets.select(*ends, *[F.size(c).cast("long").alias(f"n_{c}") for c in ("lat", "lon", "time")])


def align_inner(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner", block: str | None = None) -> DataFrame:
    """Align two cubes on exact coordinates (C10).  ``how='exact'`` raises
    through the caller's check of :func:`alignment_mismatch`.  Both are shuffled:
    a cube is never small enough to broadcast, whatever the planner assumes.

    With ``block``, a column of both that follows from the keys (whole numbers,
    as axis indices are), an inner alignment meets block by block, one task
    holding one block of each; cubes that are dealt by it alike are not shuffled.
    """
    if block is None or how != "inner":
        return a.join(b.hint("merge"), keys, how)
    a, b = a.dropna(subset=keys), b.dropna(subset=keys)  # a null matches nothing
    own, others = ([c for c in x.columns if c not in (*keys, block)] for x in (a, b))
    schema = T.StructType([a.schema[c] for c in (*keys, *own)] + [b.schema[c] for c in others])

    def aligned(left: pa.Table, right: pa.Table) -> pa.Table:
        at = [x.select(keys).append_column(n, pa.array(np.arange(len(x)))) for x, n in ((left, "__l"), (right, "__r"))]
        pairs = at[0].join(at[1], keys, join_type="inner", use_threads=False)
        left, right = left.take(pairs["__l"]), right.take(pairs["__r"])
        return pa.table([*(left[c] for c in (*keys, *own)), *(right[c] for c in others)], names=[*keys, *own, *others])

    return a.groupBy(block).cogroup(b.groupBy(block)).applyInArrow(aligned, schema)


def alignment_mismatch(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either side without an exact partner: empty means 'exact' holds."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return (ka.join(kb.hint("merge"), keys, "left_anti").withColumn("side", F.lit("left"))
            .unionByName(kb.join(ka.hint("merge"), keys, "left_anti").withColumn("side", F.lit("right"))))


# ------------------------------------------------------------ aggregates ----

def seasonal_mean(raster: DataFrame, variables: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean per meteorological season DJF/MAM/JJA/SON (D25) with its order."""
    by = by or []
    season = H.season_abbrev(F.month("time"))
    order = H.season_num(F.month("time"))
    return (raster.groupBy(*by, season.alias("season"), order.alias("season_order"))
            .agg(*[F.avg(v).alias(v) for v in variables]))


def monthly_mean(raster: DataFrame, variables: list[str],
                 cell: tuple[str, ...] = ("ilat", "ilon")) -> DataFrame:
    """Resample to month ends (D26): mean per (month end, cell)."""
    return (raster.groupBy(F.last_day("time").alias("month_end"), *cell)
            .agg(*[F.avg(v).alias(v) for v in variables]))


def weighted_mean(raster: DataFrame, variable: str, spec: RasterSpec,
                  by: list[str] | None = None) -> DataFrame:
    """Area-weighted mean (D27): sum(v*w) / sum(w where v not null),
    ``w = R^2 dphi dlambda cos(phi)``."""
    w = H.cell_area_m2(F.col("lat"), abs(spec.lat.step), abs(spec.lon.step))
    v = F.col(variable)
    return raster.groupBy(*(by or [])).agg(
        (F.sum(v * w) / F.sum(F.when(v.isNotNull(), w))).alias(f"{variable}_wmean"))


def dim_mean(raster: DataFrame, variables: list[str], keep: list[str]) -> DataFrame:
    """Mean over the dimensions not in ``keep``."""
    return raster.groupBy(*keep).agg(*[F.avg(v).alias(v) for v in variables])


def coarsen(raster: DataFrame, variables: list[str], k_lat: int, k_lon: int,
            keep: tuple[str, ...] = ("itime",)) -> DataFrame:
    """Block mean over ``k_lat x k_lon`` cells."""
    return (raster.groupBy(*keep, F.floor(F.col("ilat") / k_lat).cast("int").alias("blat"),
                           F.floor(F.col("ilon") / k_lon).cast("int").alias("blon"))
            .agg(*[F.avg(v).alias(v) for v in variables]))


def annual_features(raster: DataFrame, cell: tuple[str, ...] = ("ilat", "ilon")) -> DataFrame:
    """Per cell and year: mean temperature, total precipitation, mean
    radiation and mean VPD (D31)."""
    return (raster.groupBy(*cell, F.year("time").alias("year"))
            .agg(F.avg("air_temperature").alias("mean_air_temperature"),
                 F.sum("precipitation_amount").alias("total_precipitation"),
                 F.avg("surface_downwelling_shortwave_flux_in_air").alias("mean_srad"),
                 F.avg("mean_vapor_pressure_deficit").alias("mean_vpd")))


def rolling_mean(annual: DataFrame, value: str, years: int = 3,
                 cell: tuple[str, ...] = ("ilat", "ilon"), order: str = "year") -> DataFrame:
    """Trailing mean over ``years`` rows per cell (E7).  The window is
    partitioned by cell, so each task holds one cell's time series."""
    w = Window.partitionBy(*cell).orderBy(order).rowsBetween(-(years - 1), 0)
    return annual.withColumn(f"{value}_rolling", F.avg(value).over(w))


def to_wide(raster: DataFrame, variable: str, lon_values: list[float] | None = None) -> DataFrame:
    """Cube -> table of rows per (time, lat) and one column per lon.

    Pass ``lon_values`` (known from the axis) so the pivot needs no extra
    distinct job."""
    g = raster.groupBy("itime", "ilat")
    p = g.pivot("ilon", lon_values) if lon_values is not None else g.pivot("ilon")
    return p.agg(F.first(variable))


def from_wide(wide: DataFrame, value: str, column_axis: str = "ilon", prefix: str = "") -> DataFrame:
    """Wide table -> cube (A15): one row for each (row axes, column axis), the inverse of :func:`to_wide`.

    Columns named ``prefix`` and a whole number are values of the column axis,
    all others row axes.
    """
    named = {c: c[len(prefix):] for c in wide.columns if c.startswith(prefix) and c[len(prefix):].lstrip("-").isdigit()}
    if not named:
        raise ValueError(f"no columns of axis {column_axis}")
    rows = [c for c in wide.columns if c not in named]
    long = wide.unpivot(rows, list(named), "__c", value)
    return long.select(*rows, F.substring("__c", len(prefix) + 1, 20).cast("int").alias(column_axis), value)


def density(cube: DataFrame, axes: list[str]) -> DataFrame:
    """A15 check before a table becomes an array: one row with ``n_rows``, ``n_cells`` (product of
    the axes' sizes), ``n_repeated`` coordinates and ``dense``."""
    per = cube.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"))
    sizes = [F.size(F.collect_set(a)).cast("long") for a in axes]  # an axis a set
    cells = sizes[0]
    for x in sizes[1:]:
        cells = cells * x
    one = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), cells.alias("n_cells"), F.count_if(F.col("n") > 1).alias("n_repeated"))
    return one.withColumn("dense", (F.col("n_rows") == F.col("n_cells")) & (F.col("n_repeated") == 0))


def broadcast_axes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cartesian product of two small axis tables (C9); both are axis-sized."""
    return a.crossJoin(F.broadcast(b))
