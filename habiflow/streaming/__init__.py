"""Structured Streaming forms of the incremental jobs.

New occurrence files land in a folder; a file stream applies the stateless
cleaning steps, joins the static raster (stream-static join), keeps the first
row of an id by event-time sessions and appends to a Parquet sink.  Progress lives in the
query checkpoint, so a restarted job resumes exactly where it stopped (the
streaming form of the reference's resume-by-key loop).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habiflow.operators import clean as C
from habiflow.operators import raster as R
from habiflow.session import stage_path


# The days that :func:`clean_stateless` lets through.
DAYS = (C.GRID_BOUNDS["time_min"], C.GRID_BOUNDS["time_max"])


def clean_stateless(df: DataFrame, time_filter: bool = True) -> DataFrame:
    """L1 without the keep-first de-duplication (which needs state; see
    :func:`dedup_stream`)."""
    x = C.drop_all_null(df)
    x = C.fill_unknown(x)
    x = C.clean_state_names(x)
    x = C.coerce_numeric(x)
    x = C.filter_bounds_keep_missing(x)
    x = C.filter_country(x)
    x = C.drop_invalid_coords(x)
    x = C.round_coords(x)
    x = C.process_dates(x)
    x = x.withColumn("occurrence", F.lit(1))
    return C.filter_time_bounds(x) if time_filter else x


def land_in_slices(df: DataFrame, folder: str, slice_col: str, n_slices: int = 4) -> None:
    """Write ``df`` as ``n_slices`` successive appends ordered by ``slice_col``
    (simulates files arriving over time; one write per slice)."""
    lo_hi = df.agg(F.min(slice_col).alias("lo"), F.max(slice_col).alias("hi")).collect()[0]
    lo, hi = lo_hi["lo"], lo_hi["hi"]
    if lo is None:
        df.limit(0).write.mode("append").parquet(folder)
        return
    span = (hi - lo) / n_slices
    for i in range(n_slices):
        a = lo + span * i
        cond = (F.col(slice_col) >= F.lit(a))
        if i < n_slices - 1:
            cond = cond & (F.col(slice_col) < F.lit(a + span))
        df.filter(cond).write.mode("append").parquet(folder)


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append a stream to a file sink with the ``availableNow`` trigger:
    processes everything that has landed, in micro-batches, then stops."""
    q = (stream.writeStream.format(fmt).option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_stream(stream: DataFrame, key: str, event_time: str, order: str, delay: str = "2 days") -> DataFrame:
    """Of the rows of an id the first by ``order`` (E1's keep-first), whichever arrives first.

    Rows of an id whose event times lie within ``delay`` of each other are one
    session; it is emitted once the watermark has passed its end, so state
    holds the open sessions only, a row each.  Rows without an event time are
    dropped; rows without an id are one id.  Sessions that are open at the end
    of the input stay in the state; :func:`close_landing` closes them.
    """
    first = F.min_by(F.struct(*stream.columns), F.col(order))
    return (stream.withWatermark(event_time, delay).groupBy(F.session_window(event_time, delay), key)
            .agg(first.alias("first")).select("first.*"))


def close_landing(df: DataFrame, folder: str, event_time: str, after: str = "30 days") -> None:
    """Land a row without values beyond every event time of ``df``, which moves the watermark past all sessions."""
    last = df.agg((F.max(event_time) + F.expr(f"INTERVAL {after}")).alias(event_time))
    cols = [F.col(f.name) if f.name == event_time else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    last.select(*cols).write.mode("append").parquet(folder)


def append_batches(stream: DataFrame, enrich: Callable[[DataFrame], DataFrame], key: Sequence[str], sink: str, checkpoint: str) -> None:
    """Enrich the keys of each micro-batch that the sink doesn't hold yet and append them.

    A micro-batch writes its own folder ``batch=<id>`` and looks only at the
    folders of earlier batches, so one that is run again after a failure
    replaces what it wrote before and adds nothing.
    """
    from habiflow.sources import resume_pending

    def write(rows: DataFrame, batch: int) -> None:
        earlier = [f"{sink}/batch={b}" for b in range(batch)]
        todo = resume_pending(rows, rows.sparkSession.read.parquet(*earlier), key) if earlier else rows
        enrich(todo).write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def scratch_folders(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """Fresh landing / sink / checkpoint folders under the shared checkpoint dir."""
    base = stage_path(spark, f"stream_{name}_{uuid.uuid4().hex[:12]}")
    return (os.path.join(base, "landing"), os.path.join(base, "sink"), os.path.join(base, "checkpoint"))


def enrich_stream(spark: SparkSession, landing: str, schema, raster: DataFrame, spec: R.RasterSpec,
                  max_files: int = 1) -> DataFrame:
    """File stream of occurrences -> stateless clean -> stream-static
    nearest-cell join, of the raster's days that the clean lets through.  A
    raster from :func:`R.held_days` is not shuffled for each micro-batch."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
    return R.nearest_cell_join(clean_stateless(s), raster, spec, days=DAYS)
