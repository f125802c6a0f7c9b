"""Sources and sinks.

Readers return DataFrames with explicit schemas (no inference on the hot
path); sinks write Parquet/CSV/JSON with Spark writers.  Nothing here pulls
data through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habiflow.session import cut_lineage

# Columns of the occurrence dump the pipeline uses, with their types.  All
# other columns of a 200+ column dump are read as text and pruned by select.
OCCURRENCE_TYPES: dict[str, str] = {
    "gbifID": "bigint", "decimalLatitude": "double", "decimalLongitude": "double",
    "eventDate": "string", "year": "double", "month": "double", "day": "double",
    "startDayOfYear": "double", "verbatimEventDate": "string", "dateIdentified": "string",
    "countryCode": "string", "stateProvince": "string", "county": "string",
    "municipality": "string", "locality": "string", "verbatimLocality": "string",
    "continent": "string", "basisOfRecord": "string", "occurrenceStatus": "string",
    "elevation": "double",
}
GATE_COLUMNS = ("eventDate", "countryCode", "county")


def type_occurrence_text(df: DataFrame, types: dict[str, str] = OCCURRENCE_TYPES) -> DataFrame:
    """Cast known text columns to their types with try_cast (bad -> null)."""
    out = []
    for c in df.columns:
        t = types.get(c)
        if t is not None and t != "string":
            out.append(F.col(c).try_cast(t).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def read_occurrences(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     required: Sequence[str] = GATE_COLUMNS, add_order: bool = True) -> DataFrame:
    """Read a tab-separated occurrence dump (A1) with the required-column gate (A2).

    The header is read for names only; every column is text and the used
    ones are typed with try_cast.  ``ord`` records file order
    (partition-stable ``monotonically_increasing_id``) for keep-first dedup.
    """
    raw = (spark.read.option("sep", "\t").option("header", True).option("quote", "\u0000")
           .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    if columns is not None:
        raw = raw.select(*[c for c in columns if c in raw.columns])
    df = type_occurrence_text(raw)
    if add_order:
        df = df.withColumn("ord", F.monotonically_increasing_id())
    return df


CORRUPT = "_corrupt_record"


def read_dump(spark: SparkSession, path: str, required: Sequence[str] = GATE_COLUMNS,
              types: dict[str, str] = OCCURRENCE_TYPES) -> tuple[DataFrame, DataFrame]:
    """A1/A2 on read: the typed rows of a tab-separated dump, and its malformed lines.

    The gate sees the header only.  The header gives the schema, all text and a
    channel for lines with more or fewer fields than it; those come back as
    ``_corrupt_record`` and nowhere else.  Texts that are no number where one
    is due are null, as in :func:`read_occurrences`.  A folder may hold many
    files, each with its header.
    """
    reader = spark.read.option("sep", "\t").option("quote", "\u0000").option("recursiveFileLookup", True)
    names = reader.option("header", True).csv(path).columns
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    rows = (reader.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False)  # else fields that no one reads are not counted
            .csv(path))
    good = type_occurrence_text(rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), types)
    # stored with a parsed column, as Spark refuses to parse lines for this one alone
    bad = cut_lineage(rows.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, names[0]))
    return good, bad.select(CORRUPT)


def write_dump(lines: DataFrame, names: Sequence[str], path: str, files: int = 4) -> None:
    """Write ``lines(value)`` as ``files`` text files that each begin with the header of ``names``."""
    n = F.pmod(F.xxhash64("value"), F.lit(files)).cast("int")
    head = lines.sparkSession.range(files).select(F.lit("\t".join(names)).alias("value"), F.col("id").cast("int").alias("file"), F.lit(0).alias("at"))
    body = lines.select("value", n.alias("file"), F.lit(1).alias("at"))
    (head.unionByName(body).repartition("file").sortWithinPartitions("file", "at").select("file", "value")
     .write.mode("overwrite").partitionBy("file").text(path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None) -> DataFrame:
    """Read a processed / enriched stage table (A3)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Write a stage table (A4/A12); Parquet by default, CSV with header."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_json_summary(summary: DataFrame, path: str) -> None:
    """A5: a one-row report frame written as JSON lines (no driver collect)."""
    summary.write.mode("overwrite").json(path)


def write_above_threshold(df: DataFrame, path: str, threshold: float = 0.8,
                          col: str = "probability") -> None:
    """A5: threshold-filtered predictions, sorted by probability desc."""
    (df.filter(F.col(col) >= threshold).orderBy(F.col(col).desc())
       .write.mode("overwrite").option("header", True).csv(path))


def manual_geocode_map(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """JSON documents ``{place: {lat, lon}}`` -> (place, lat, lon) rows."""
    m = F.from_json(F.col(body_col), "map<string,struct<lat:double,lon:double>>")
    return (docs.select(F.explode(m).alias("place", "coord"))
                .select("place", F.col("coord.lat").alias("lat"), F.col("coord.lon").alias("lon")))


def points_from_array(df: DataFrame, arr_col: str, key: str, strict: bool = True) -> DataFrame:
    """Flat [lat1, lon1, lat2, lon2, ...] arrays -> one row per point.

    An odd-length array is an error; without ``strict`` its last value is left
    out and :func:`odd_length_rows` lists the row.
    """
    n = F.size(F.col(arr_col))
    if strict:
        n = F.when(n % 2 == 1, F.raise_error(F.lit("coordinate list of odd length")).cast("int")).otherwise(n)
    pairs = F.transform(F.sequence(F.lit(0), F.floor(n / 2).cast("int") - 1),
                        lambda i: F.struct(i.alias("point_idx"),
                                           F.element_at(F.col(arr_col), 2 * i + 1).alias("lat"),
                                           F.element_at(F.col(arr_col), 2 * i + 2).alias("lon")))
    return (df.filter(n >= 2).select(key, F.explode(pairs).alias("p"))
              .select(key, "p.point_idx", "p.lat", "p.lon"))


def odd_length_rows(df: DataFrame, arr_col: str) -> DataFrame:
    return df.filter(F.size(F.col(arr_col)) % 2 == 1)


def bbox_grid(spark: SparkSession, lat_min: float, lat_max: float, lon_min: float,
              lon_max: float, step: float) -> DataFrame:
    """Half-open regular grid over a box (numpy ``arange`` semantics).

    Sizes are ceil((max - min) / step); both axes come from ``spark.range``
    and their product is a distributed cross join of two axis-sized tables.
    """
    import math
    n_lat = max(0, math.ceil((lat_max - lat_min) / step))
    n_lon = max(0, math.ceil((lon_max - lon_min) / step))
    la = spark.range(n_lat).select(F.col("id").alias("i"),
                                   (F.lit(lat_min) + F.col("id") * F.lit(step)).alias("lat"))
    lo = spark.range(n_lon).select(F.col("id").alias("j"),
                                   (F.lit(lon_min) + F.col("id") * F.lit(step)).alias("lon"))
    return la.crossJoin(lo)


def resume_pending(todo: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``todo`` not yet in the output, by key (left anti join)."""
    return todo.join(done.select(*key).distinct(), list(key), "left_anti")


def append_resumable(todo: DataFrame, out_path: str, key: Sequence[str], enrich,
                     fmt: str = "parquet") -> int:
    """Enrich only pending rows and append them; returns rows appended.

    Restartable: a crash loses at most the batch in flight, and a rerun
    recomputes exactly the missing keys.
    """
    spark = todo.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    pending = todo
    # only a missing output is a first run; any error in reading it is raised
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        pending = resume_pending(todo, spark.read.format(fmt).load(out_path), key)
    written = Observation()
    enrich(pending).observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt).save(out_path)
    return int(written.get["n"])


def identical(a: DataFrame, b: DataFrame) -> DataFrame:
    """One-row frame ``identical`` = both ``exceptAll`` differences empty
    and schemas equal."""
    if a.schema.simpleString() != b.schema.simpleString():
        return a.sparkSession.createDataFrame([(False,)], "identical boolean")
    d = a.exceptAll(b).unionAll(b.exceptAll(a))
    return d.agg((F.count(F.lit(1)) == 0).alias("identical"))
