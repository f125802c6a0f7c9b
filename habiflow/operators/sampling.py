"""Distance buffers, background points and reproducible sampling
(SURVEY C7, K2, E3-E6, H9, H10).

No operator here uses a window without a partition key or a driver-side
loop over rows.  Exact "first n" / rank selections go through
:func:`bucket_rank`, which ranks inside hash-uniform buckets of bounded
size and adds bucket offsets from a small per-bucket count table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habiflow import functions as H
from habiflow.session import cut_lineage

LAT, LON = "decimalLatitude", "decimalLongitude"

# --- fixed values that must equal the reference's (do not edit) ----------
BUFFER_KM = 5.0
PSEUDO_RATIO = 3.0
MAX_ATTEMPT_FACTOR = 20
SEED = 42
# --------------------------------------------------------------------------


# ------------------------------------------------------------ ranking ----

RANK_BUCKETS = 1 << 16   # window partitions hold n / 65536 rows; count table <= 65536 rows per group


def bucket_rank(df: DataFrame, order: str, key: str, by: Sequence[str] = (),
                buckets: int = RANK_BUCKETS, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Exact 0-based rank of each row within ``by`` groups, ordered by
    (``order``, ``key``); ``order`` must be a number spread over [lo, hi).

    Rows are cut into ``buckets`` equal-width ranges of ``order``; a window
    partitioned by (group, bucket) ranks rows inside a bucket (bounded size
    when ``order`` is uniform), and the bucket's start offset comes from a
    tiny (group x bucket) count table.  Also adds ``group_n`` (group size).
    """
    by = list(by)
    b = F.least(F.greatest(F.floor((F.col(order) - F.lit(lo)) / F.lit((hi - lo) / buckets)),
                           F.lit(0)), F.lit(buckets - 1)).cast("int")
    x = df.withColumn("__b", b)
    counts = x.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    wprev = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*by)
    starts = (counts.withColumn("__start", F.coalesce(F.sum("__cnt").over(wprev), F.lit(0)))
                    .withColumn("group_n", F.sum("__cnt").over(wall))
                    .drop("__cnt"))
    w = Window.partitionBy(*by, "__b").orderBy(F.col(order), F.col(key))
    local = x.withColumn("__r", F.row_number().over(w) - 1)
    out = local.join(starts, by + ["__b"])
    return (out.withColumn("rank", (F.col("__start") + F.col("__r")).cast("bigint"))
               .drop("__b", "__r", "__start"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, salt: str = "fold",
                     buckets: int = RANK_BUCKETS) -> DataFrame:
    """Deal rows of each label round-robin into ``k`` folds after a
    reproducible hash shuffle: fold = rank_within_label mod k."""
    x = df.withColumn("__u", H.uniform(salt, key))
    r = bucket_rank(x, "__u", key, by=[label], buckets=buckets)
    return r.withColumn("fold", (F.col("rank") % k).cast("int")).drop("__u", "rank", "group_n")


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, salt: str = "split",
                     buckets: int = RANK_BUCKETS) -> DataFrame:
    """Exact-size split: the first ceil(n * test_size) rows in hash
    order are the test set (16 -> 4/12, 15 -> 3/12).  Adds ``is_test``."""
    x = df.withColumn("__u", H.uniform(salt, key)).withColumn("__all", F.lit(0))
    r = bucket_rank(x, "__u", key, by=["__all"], buckets=buckets)
    n_test = F.ceil(F.col("group_n") * F.lit(test_size) - F.lit(1e-9))
    return r.withColumn("is_test", F.col("rank") < n_test).drop("__u", "__all", "rank", "group_n")


def hash_shuffle(df: DataFrame, key: str, seed: int = SEED, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Reproducible shuffle position (0..n-1) from md5(seed:key)."""
    x = df.withColumn("__u", H.uniform(str(seed), key)).withColumn("__all", F.lit(0))
    r = bucket_rank(x, "__u", key, by=["__all"], buckets=buckets)
    return r.withColumnRenamed("rank", "shuffle_pos").drop("__u", "__all", "group_n")


# ------------------------------------------------------- buffer join C7 ----
#
# Points are put on the sphere as x, y, z in km and dealt to cubic cells.  A
# chord is never longer than its arc, so points within d km lie within d km
# here too: the same at the poles and across the 180 degree line.

AXES = ("x", "y", "z")
SLACK_KM = 1e-6   # above the rounding of a coordinate of some thousands of km
LEAF = 16         # most reference points of a cell that are compared one by one


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``df`` with ``__x, __y, __z`` in km."""
    la, lo, r = F.radians(F.col(lat)), F.radians(F.col(lon)), F.lit(H.EARTH_RADIUS_KM)
    return df.withColumns({"__x": r * F.cos(la) * F.cos(lo), "__y": r * F.cos(la) * F.sin(lo), "__z": r * F.sin(la)})


def _cell(size: float) -> list[Column]:
    return [F.floor(F.col(f"__{a}") / F.lit(size)).cast("bigint").alias(f"__c{a}") for a in AXES]


def _box_distance(size: float) -> Column:
    """Distance in km from the point to its row's cell, which is ``size`` wide."""
    total = F.lit(0.0)
    for a in AXES:
        low = F.col(f"__c{a}") * F.lit(size)
        off = F.greatest(low - F.col(f"__{a}"), F.col(f"__{a}") - (low + F.lit(size)), F.lit(0.0))
        total = total + off * off
    return F.sqrt(total)


def _meets_sphere(size: float) -> Column:
    """Whether the row's cell holds a piece of the sphere; others hold no point."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in AXES:
        low = F.col(f"__c{a}") * F.lit(size)
        high = low + F.lit(size)
        near = near + F.greatest(low, -high, F.lit(0.0)) ** 2
        far = far + F.greatest(F.abs(low), F.abs(high)) ** 2
    r = H.EARTH_RADIUS_KM
    return (near <= F.lit((r + SLACK_KM) ** 2)) & (far >= F.lit((r - SLACK_KM) ** 2))


def _around(df: DataFrame, size: float, within: Column) -> DataFrame:
    """A row for each cell that the ball of ``within`` km around the point reaches."""
    within = within + F.lit(SLACK_KM)
    x = df
    for a in AXES:
        ends = [F.floor((F.col(f"__{a}") + w) / F.lit(size)).cast("bigint") for w in (-within, within)]
        x = x.withColumn(f"__c{a}", F.explode(F.sequence(*ends)))
    return x.filter((_box_distance(size) <= within) & _meets_sphere(size))


def _distinct_points(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``__rlat, __rlon, __x, __y, __z``: a site that many rows share is one point."""
    points = (df.select(F.col(lat).alias("__rlat"), F.col(lon).alias("__rlon"))
              .filter(F.col("__rlat").isNotNull() & F.col("__rlon").isNotNull()).distinct())
    return _on_sphere(points, "__rlat", "__rlon")


def exclude_within(candidates: DataFrame, references: DataFrame, buffer_km: float = BUFFER_KM,
                   lat: str = LAT, lon: str = LON, ref_lat: str = LAT, ref_lon: str = LON) -> DataFrame:
    """Keep candidates whose nearest reference point is >= buffer_km away.

    Reference points are reduced to distinct coordinates, dealt to the cells
    that their buffer reaches, equi-joined to the candidate's cell and tested
    with the exact haversine; ``left_anti`` keeps the survivors.  Rows with
    null coordinates never match and survive, as in the reference's filter
    order.
    """
    keys = [f"__c{a}" for a in AXES]
    refs = _around(_distinct_points(references, ref_lat, ref_lon), buffer_km, F.lit(float(buffer_km))).select("__rlat", "__rlon", *keys)
    cand = _on_sphere(candidates, lat, lon).select(*candidates.columns, *_cell(buffer_km))
    cond = H.haversine_km(cand[lat], cand[lon], refs["__rlat"], refs["__rlon"]) < F.lit(buffer_km)
    for k in keys:
        cond = (cand[k] == refs[k]) & cond
    return cand.join(refs, cond, "left_anti").drop(*keys)


STRIPS = 3             # rows of grid cells in a buffer's radius
COVERED_WORDS = 2_000_000   # words of 64 grid cells that are broadcast


def _grid(lat: Column, lon: Column, step: float) -> tuple[Column, Column]:
    return F.floor((lat + 90) / F.lit(step)).cast("bigint"), F.floor((lon + 180) / F.lit(step)).cast("bigint")


def covered_words(references: DataFrame, buffer_km: float, lat: str = LAT, lon: str = LON) -> DataFrame | None:
    """Grid cells that lie wholly within ``buffer_km`` of a reference: a row (``__word, __bits``) for 64 in a row.

    The grid is one of degrees, ``STRIPS`` rows to the buffer's radius.  The
    point of a grid cell that is farthest from the reference is a corner, so a
    row's covered cells lie between two longitudes.  As many rows as the
    buffers' area asks for, however dense the references are; None where they
    are too many for a broadcast.
    """
    step = math.degrees(buffer_km / STRIPS / H.EARTH_RADIUS_KM)
    reach = (buffer_km * (1 - 1e-6) - SLACK_KM) / H.EARTH_RADIUS_KM
    x = references.select(F.col(lat).alias("la"), F.col(lon).alias("lo")).filter(F.col("la").between(-90, 90) & F.col("lo").between(-180, 180))
    x = x.select("la", "lo", F.explode(F.sequence(F.lit(-STRIPS), F.lit(STRIPS))).alias("k"))
    x = x.select("la", "lo", (_grid(F.col("la"), F.col("lo"), step)[0] + F.col("k")).alias("y"))
    edges = [F.col("y") * F.lit(step) - 90, (F.col("y") + 1) * F.lit(step) - 90]
    half = []   # of the chord at each edge of the row, in degrees; NaN: the edge is beyond the buffer or the pole
    for edge in edges:
        left = F.lit(math.sin(reach / 2) ** 2) - F.sin(F.radians(edge - F.col("la")) / 2) ** 2
        half.append(F.degrees(2 * F.asin(F.sqrt(F.try_divide(left, F.cos(F.radians(edge)) * F.cos(F.radians(F.col("la"))))))))
    # generated, so that later columns don't repeat the sines
    x = x.select("lo", "y", F.explode(F.array(F.struct(half[0].alias("p"), half[1].alias("q")))).alias("h"))
    x = x.select("y", "lo", F.least("h.p", "h.q").alias("h"), (F.col("h.p") + F.col("h.q")).alias("both")).filter("both IS NOT NULL AND NOT isnan(both)")
    x = x.select("y", F.greatest(F.ceil((F.col("lo") - F.col("h") + 180) / F.lit(step)), F.lit(0)).cast("bigint").alias("a"),
                 (F.floor((F.col("lo") + F.col("h") + 180) / F.lit(step)) - 1).cast("bigint").alias("b")).filter("a <= b")
    x = x.select("y", "a", "b", F.explode(F.sequence(F.shiftright("a", 6), F.shiftright("b", 6))).alias("w"))
    bits = F.expr("shiftleft(-1L, cast(greatest(a - w * 64, 0L) as int)) & shiftrightunsigned(-1L, cast(63 - least(b - w * 64, 63L) as int))")
    words = cut_lineage(x.select(_word_key(F.col("y"), F.col("w")).alias("__word"), bits.alias("bits"))
                        .groupBy("__word").agg(F.bit_or("bits").alias("__bits")))
    return words if words.count() <= COVERED_WORDS else None


def _word_key(y: Column, word: Column) -> Column:
    return y * F.lit(1 << 31) + word


def drop_covered(candidates: DataFrame, words: DataFrame, buffer_km: float, lat: str = LAT, lon: str = LON) -> DataFrame:
    """``candidates`` without those in a cell of :func:`covered_words`; all that :func:`exclude_within` keeps stay."""
    step = math.degrees(buffer_km / STRIPS / H.EARTH_RADIUS_KM)
    y, x = _grid(F.col(lat), F.col(lon), step)
    inside = F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)
    c = candidates.withColumns({"__word": F.when(inside, _word_key(y, F.shiftright(x, 6))), "__at": F.when(inside, F.pmod(x, F.lit(64))).cast("int")})
    c = c.join(F.broadcast(words), "__word", "left")
    return c.filter(F.coalesce(F.expr("shiftright(__bits, __at) & 1L"), F.lit(0)) == 0).select(*candidates.columns)


def nearest_distance(candidates: DataFrame, references: DataFrame, key: str, radius_km: float = BUFFER_KM,
                     lat: str = LAT, lon: str = LON, leaf: int = LEAF) -> DataFrame:
    """Distance (km) to the nearest reference within ``radius_km``; null when none is that close.

    Every distinct candidate place is measured to a few points of its own cell,
    in cells that hold some ``leaf`` / 4 points on average; places whose cell is
    empty go to cells twice as wide, up to the radius.  The nearest of those
    points is the place's bound, and only cells within it are looked at: those
    of at most ``leaf`` points are measured, fuller ones are cut in half along
    each axis with the bound renewed (:func:`_split_cells`).  So rows follow the
    places, a few cells each, however dense the references are.
    """
    cell = [f"__c{a}" for a in AXES]
    refs = cut_lineage(_distinct_points(references, lat, lon))
    places = _on_sphere(candidates.select(F.col(lat).alias("__lat"), F.col(lon).alias("__lon"))
                        .filter("__lat IS NOT NULL AND __lon IS NOT NULL").distinct(), "__lat", "__lon")
    place = ["__lat", "__lon", "__x", "__y", "__z"]
    level = _first_level(refs, float(radius_km), leaf)
    table = lru_cache(None)(lambda k: cut_lineage(_cells_with_points(refs, radius_km / 2 ** k)))  # of each width once
    near: dict[int, list[DataFrame]] = {}
    todo = places
    while level >= 0:
        size, cells = radius_km / 2 ** level, table(level)
        own = cut_lineage(todo.withColumns(dict(zip(cell, _cell(size)))).join(cells.drop("__n"), cell, "left").select(
            *place, F.least(F.lit(float(radius_km)), *[_chord(p) for p in BOUND_POINTS]).alias("__best"),
            F.col(BOUND_POINTS[0]).isNotNull().alias("__own")))
        todo = own.filter("NOT __own").select(*place)
        ring = _around((own.filter("__own") if level else own).drop("__own"), size, F.col("__best")).join(cells.select(*cell, "__n"), cell)
        near.setdefault(level, []).append(ring.filter(F.col("__n") <= leaf).select("__lat", "__lon", *cell))
        if not cells.filter(F.col("__n") > leaf).isEmpty():
            for k, part in _split_cells(ring.filter(F.col("__n") > leaf), table, level, radius_km, leaf):
                near.setdefault(k, []).append(part)
        level = -1 if level and todo.isEmpty() else level - 1
    found = [_measured(reduce(DataFrame.unionByName, parts), refs, radius_km / 2 ** k, radius_km) for k, parts in near.items()]
    best = reduce(DataFrame.unionByName, found).groupBy("__lat", "__lon").agg(F.min("__d").alias("__d"))
    rows = candidates.select(F.col(key), F.col(lat).alias("__a"), F.col(lon).alias("__b"))
    return (rows.join(best, (F.col("__a") == F.col("__lat")) & (F.col("__b") == F.col("__lon")), "left")
            .groupBy(key).agg(F.min("__d").alias("nearest_km")))


BOUND_POINTS = [f"__one{i}" for i in range(4)]   # points of a cell that give a first bound
LEVELS = 16


def _first_level(refs: DataFrame, radius: float, leaf: int) -> int:
    """The least halving of ``radius`` whose occupied cells hold ``leaf`` / 4 points on average."""
    counts = refs.agg(F.count(F.lit(1)).alias("n"), *[
        F.approx_count_distinct(F.xxhash64(*_cell(radius / 2 ** k))).alias(f"c{k}") for k in range(LEVELS)]).first()  # one row
    return next((k for k in range(LEVELS) if counts["n"] <= counts[f"c{k}"] * leaf / 4), LEVELS - 1)


def _cells_with_points(refs: DataFrame, size: float) -> DataFrame:
    """The occupied cells: their number of points and some of these, by hash (they may coincide)."""
    return (refs.withColumns(dict(zip([f"__c{a}" for a in AXES], _cell(size)))).groupBy(*[f"__c{a}" for a in AXES])
            .agg(F.count(F.lit(1)).alias("__n"), *[F.min_by(F.struct("__x", "__y", "__z"), F.xxhash64(F.lit(i), "__x", "__y", "__z")).alias(p)
                                                  for i, p in enumerate(BOUND_POINTS)]))


def _chord(point: str) -> Column:
    return F.sqrt(sum(((F.col(f"{point}.__{a}") - F.col(f"__{a}")) ** 2 for a in AXES), F.lit(0.0)))


def _measured(ring: DataFrame, refs: DataFrame, size: float, radius_km: float) -> DataFrame:
    """``__lat, __lon, __d``: the exact distance of each place to the nearest point of its rows' cells, if in the radius."""
    points = refs.select("__rlat", "__rlon", *_cell(size))
    dist = H.haversine_km(F.col("__lat"), F.col("__lon"), F.col("__rlat"), F.col("__rlon"))
    return (ring.join(points, [f"__c{a}" for a in AXES]).withColumn("__d", dist).filter(F.col("__d") < F.lit(radius_km))
            .groupBy("__lat", "__lon").agg(F.min("__d").alias("__d")))


def _split_cells(ring: DataFrame, table: Callable[[int], DataFrame], level: int, radius_km: float, leaf: int) -> list[tuple[int, DataFrame]]:
    """Level and rows (``__lat, __lon`` and cell) for :func:`_measured` from cells of more than ``leaf`` points:
    halved until they hold fewer or are too small; each round's points renew the place's bound, and cells beyond
    it are dropped."""
    cell = [f"__c{a}" for a in AXES]
    ring, parts = cut_lineage(ring.drop("__n")), []
    while not ring.isEmpty():
        level += 1
        size = radius_km / 2 ** level
        for a in AXES:  # the two halves of each axis
            ring = ring.withColumn(f"__c{a}", F.explode(F.array(2 * F.col(f"__c{a}"), 2 * F.col(f"__c{a}") + 1)))
        ring = ring.filter((_box_distance(size) <= F.col("__best") + F.lit(SLACK_KM)) & _meets_sphere(size))
        near = F.min(F.least("__best", *[_chord(p) for p in BOUND_POINTS])).over(Window.partitionBy("__lat", "__lon"))  # the ring of one place
        ring = cut_lineage(ring.join(table(level), cell).withColumn("__best", near).drop(*BOUND_POINTS)
                           .filter(_box_distance(size) <= F.col("__best") + F.lit(SLACK_KM)))
        last = size < 100 * SLACK_KM
        parts.append((level, (ring if last else ring.filter(F.col("__n") <= leaf)).select("__lat", "__lon", *cell)))
        if last:
            break
        ring = ring.filter(F.col("__n") > leaf).drop("__n")
    return parts


# ------------------------------------------------------ pseudo-absence K2 ----

def absence_attempts(spark, start: int, end: int, extent: DataFrame) -> DataFrame:
    """Attempts ``[start, end)``: uniform point in the presence box and a
    uniform day in the presence date range (md5 uniforms of the attempt id)."""
    ids = spark.range(start, end).withColumnRenamed("id", "attempt")
    a = ids.crossJoin(F.broadcast(extent))
    return a.select(
        "attempt",
        (F.col("lat_min") + (F.col("lat_max") - F.col("lat_min")) * H.uniform("plat", "attempt")).alias(LAT),
        (F.col("lon_min") + (F.col("lon_max") - F.col("lon_min")) * H.uniform("plon", "attempt")).alias(LON),
        H.random_date("d_min", "d_max", H.uniform("pdate", "attempt")).alias("absence_date"))


def presence_extent(presences: DataFrame, date_col: str = "datetime") -> DataFrame:
    """One-row box and date range of the presences (plus their count)."""
    return presences.agg(F.min(LAT).alias("lat_min"), F.max(LAT).alias("lat_max"),
                         F.min(LON).alias("lon_min"), F.max(LON).alias("lon_max"),
                         F.to_date(F.min(date_col)).alias("d_min"), F.to_date(F.max(date_col)).alias("d_max"),
                         F.count(F.lit(1)).alias("n_presence"))


def pseudo_absences(presences: DataFrame, ratio: float = PSEUDO_RATIO, buffer_km: float = BUFFER_KM,
                    max_factor: int = MAX_ATTEMPT_FACTOR, date_col: str = "datetime",
                    rounds: Sequence[float] = (1.5, 4, 10, 20), block: int = 1_000_000) -> DataFrame:
    """K2: up to int(n * ratio) background points, each >= buffer_km from
    every presence; attempts are numbered and the first accepted attempts
    win (at most ``max_factor`` x target attempts; may return fewer).

    Attempts are generated in growing rounds; a round that can't bring enough
    at the rate so far becomes part of the next.  Attempts in grid cells that a
    presence's buffer covers whole fall before any shuffle, the others by the
    exact test.  Each round's survivors are
    written to the checkpoint folder (reliable, lineage cut) and counted;
    generation stops once enough survived.  The final "first target by
    attempt id" uses block counts + a per-block rank, never a global window.
    Output: lat, lon, datetime (date), year, month, day, occurrence = 0.
    """
    spark = presences.sparkSession
    # what the extent and every round need, computed once
    pres = cut_lineage(presences.filter(F.col(LAT).isNotNull() & F.col(LON).isNotNull()).select(LAT, LON, date_col))
    ext = cut_lineage(presence_extent(pres, date_col))
    info = ext.collect()[0]  # one row: box, range, count
    n = int(info["n_presence"])
    target = int(n * ratio)
    if target == 0:
        return _absence_rows(spark.range(0).select(
            F.lit(0.0).alias(LAT), F.lit(0.0).alias(LON), F.current_date().alias("absence_date"),
            F.lit(0).cast("bigint").alias("attempt")))
    max_attempts = max_factor * target
    words = covered_words(pres, buffer_km)
    kept, done, got = [], 0, 0
    for i, f in enumerate(rounds):
        end = min(max_attempts, int(math.ceil(f * target)))
        if end <= done or (done and got / done * end < target and i + 1 < len(rounds) and end < max_attempts):
            continue
        att = absence_attempts(spark, done, end, ext)
        if words is not None:
            att = drop_covered(att, words, buffer_km)
        ok = cut_lineage(exclude_within(att, pres, buffer_km))
        kept.append(ok)
        got += ok.count()
        done = end
        if got >= target or done >= max_attempts:
            break
    acc = kept[0]
    for k in kept[1:]:
        acc = acc.unionByName(k)
    nb = max(1, math.ceil(done / block))
    r = bucket_rank(acc.withColumn("__g", F.lit(0)), "attempt", "attempt", by=["__g"],
                    buckets=nb, lo=0.0, hi=float(nb * block))
    return _absence_rows(r.filter(F.col("rank") < target))


def _absence_rows(df: DataFrame) -> DataFrame:
    d = F.col("absence_date")
    return df.select(F.col("attempt"), F.col(LAT), F.col(LON),
                     d.cast("timestamp").alias("datetime"),
                     F.year(d).cast("double").alias("year"), F.month(d).cast("double").alias("month"),
                     F.dayofmonth(d).cast("double").alias("day"),
                     F.lit(0).alias("occurrence"))


def label_and_union(presences: DataFrame, absences: DataFrame) -> DataFrame:
    """G1 + T1/T2: presences labelled 1 and absences 0 *before* the union
    (labels never overwritten later); season derived after the union so
    generated rows get one too."""
    p = presences.withColumn("occurrence", F.lit(1))
    u = p.unionByName(absences.withColumn("occurrence", F.lit(0)), allowMissingColumns=True)
    return u.withColumn("season_num", H.season_num("month"))
