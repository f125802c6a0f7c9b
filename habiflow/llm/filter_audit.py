"""Operator 13: how filters interact, counted by an incremental stream with retractions.

Every document has a mask of the filters that it fails.  Four of them depend on
its text alone; the fifth, "identical to the text of a smaller id", depends on
what else has arrived.  The documents' files are read as a stream with the
available-now trigger, some files a micro-batch.  The state, keyed by the
text's SHA-256, holds the rows with the least id so far by part and label.  A
new row joins the counters with the mask that it has against the state; when a
smaller id arrives, the rows that held the least id are taken out of their
part's counter and put in again with the fifth bit set.  So what the
micro-batches hold, and their order, doesn't matter to the sums.

The state is a table of narrow rows, one folder a micro-batch, and each batch
joins it by key: one shuffle of some dozens of bytes a text seen so far.  (Python
state a text, ``applyInPandasWithState``, gave the same rows and took 12 ms a
text.)  Folders are named by the batch and overwritten, so a batch that is
repeated after a failure counts once.  Rows of a text are combined by part,
label and id before they meet, so a text that a third of all rows share comes
to its key as one row a part and label.  Orders, steps and the Shapley sums
come last, from at most 32 masks a part.

Defined cases: a null text is an empty text and has no words; a null source is
the empty part; a null doc_id never counts as smaller than another and fails
the fifth filter never; rows that repeat a text's least id all pass it; a
document with several label rows has a label if any row gives it; a null or
absent label gives none; an empty table gives no parts and so no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from habiflow.llm.common import stage_path, stored, text_or_empty, words

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
BATCHES = 8
_CHANGE = "key binary, mask int, part string, lab int, id long, n_least long, n long, none long, live boolean, back boolean"
_COUNT = "part string, mask int, lab int, n long"


def text_masks(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``mask`` of the filters A to D that ``text`` fails instead of ``text``; words are split once."""
    others = [c for c in docs.columns if c != "text"]
    found = docs.select(*others, words(F.col("text")).alias("w"), F.length("text").alias("chars"),
                        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"),
                        F.col("text").rlike(r"[#$%&*|]").alias("sign"))
    counted = found.select(*others, F.size("w").alias("n"), F.size(F.array_distinct("w")).alias("different"),
                           "chars", "capitals", "sign")
    fails = ("n < 200", "100L * different < 50L * n", "100L * capitals > 2L * chars", "sign")
    mask = sum((F.when(F.expr(f), 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return counted.select(*others, mask.cast("int").alias("mask"))


def document_labels(labels: DataFrame) -> DataFrame:
    """``label_id, lab``: 1 for quality, 2 for toxic, one row a document that has either."""
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    return (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg((flag("quality") + 2 * flag("toxic")).alias("lab")).filter("lab > 0"))


def masked_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, mask, part, lab, id``: a narrow row for each document; the texts go no further than this."""
    text = text_or_empty()
    d = text_masks(docs.select(text.alias("text"), F.unhex(F.sha2(text, 256)).alias("key"),
                               F.coalesce("source", F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("id")))
    # the first key spreads rows without an id, which meet no label
    on = (F.coalesce("id", F.xxhash64("key")) == F.col("label_id")) & (F.col("id") == F.col("label_id"))
    return d.join(labels, on, "left").select("key", "mask", "part", F.coalesce("lab", F.lit(0)).alias("lab"), "id")


def combined(rows: DataFrame) -> DataFrame:
    """A row for each text, part and label: its least ``id``, ``n_least`` rows with it, ``n`` with any id, ``none`` without."""
    by = ["key", "mask", "part", "lab"]
    named = F.col("id").isNotNull()
    one = rows.groupBy(*by, "id").agg(F.count("*").alias("n"))  # spreads the rows of a common text
    return (one.groupBy(*by).agg(F.min(F.when(named, F.struct("id", "n"))).alias("least"),
                                 F.sum(F.when(named, F.col("n")).otherwise(0)).alias("n"),
                                 F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("none"))
            .select(*by, F.col("least.id").alias("id"), F.coalesce("least.n", F.lit(0)).alias("n_least"), "n", "none"))


def changes(new: DataFrame, state: DataFrame) -> DataFrame:
    """The ``combined`` rows of a micro-batch against the state, and the state's rows that it retracts.

    ``live``: the row holds its text's least id so far and joins the state;
    ``back``: the row was live until now.
    """
    both = new.withColumn("old", F.lit(False)).unionByName(state.select(*new.columns).withColumn("old", F.lit(True)))
    w = Window.partitionBy("key")  # a row a part and label at most, and those that were ever live
    seen = both.withColumn("least", F.min("id").over(w)).withColumn("before", F.min(F.when(F.col("old"), F.col("id"))).over(w))
    back = F.col("old") & (F.col("id") == F.col("before")) & (F.col("least") < F.col("before"))
    live = ~F.col("old") & F.coalesce(F.col("id") == F.col("least"), F.lit(False))
    return seen.filter(~F.col("old") | back).select(*new.columns, live.alias("live"), F.col("old").alias("back"))


def counter_changes(rows: DataFrame) -> DataFrame:
    """``part, mask, lab, n``: what ``changes`` adds to the counters and takes away."""
    c, lit = F.col, F.lit(0).cast("long")
    first = (F.when(c("back"), -c("n_least")).otherwise(F.when(c("live"), c("n_least")).otherwise(lit) + c("none")))
    later = (F.when(c("back"), c("n_least")).otherwise(c("n") - F.when(c("live"), c("n_least")).otherwise(lit)))
    cells = F.array(F.struct(c("mask").alias("mask"), first.alias("n")),
                    F.struct(c("mask").bitwiseOR(REPEAT).alias("mask"), later.alias("n")))
    return (rows.select("part", "lab", F.explode(cells).alias("c")).groupBy("part", "c.mask", "lab")
            .agg(F.sum("c.n").alias("n")).select("part", "mask", "lab", "n"))


def counters(spark: SparkSession, documents: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``part, mask, lab, n`` over the Parquet table at ``documents``, read in about ``batches`` micro-batches."""
    table = spark.read.parquet(documents)
    some = max(1, -(-len(table.inputFiles()) // batches))
    known = stored(document_labels(labels), "labels")
    path = documents.rstrip("/")  # as a glob, as a stream takes a plain path for a folder, and the table may be one file
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", some).parquet(f"{path[:-1]}[{path[-1]}]")
    base = stage_path(spark, f"llm/filter_audit-{uuid.uuid4().hex}")
    folder = lambda name, batch: f"{base}/{name}/{batch}"

    def read(session: SparkSession, schema: str, paths: list[str]) -> DataFrame:
        return session.read.schema(schema).parquet(*paths) if paths else session.createDataFrame([], schema)

    def micro_batch(docs: DataFrame, batch: int) -> None:
        session = docs.sparkSession
        state = read(session, _CHANGE, [folder("changes", b) for b in range(batch)]).filter("live")
        (changes(combined(masked_rows(docs, known)), state)
         .write.mode("overwrite").parquet(folder("changes", batch)))
        counted = counter_changes(session.read.schema(_CHANGE).parquet(folder("changes", batch)))
        counted.write.mode("overwrite").parquet(folder("counters", batch))

    query = (stream.writeStream.foreachBatch(micro_batch).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    last = query.lastProgress
    done = [folder("counters", b) for b in range(last["batchId"] + 1)] if last else []
    return read(spark, _COUNT, done).groupBy("part", "mask", "lab").agg(F.sum("n").alias("n")).filter("n <> 0")


def _steps() -> list[dict]:
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            out.append({"filter_order": "".join(order), "step": i + 1, "before": before, "bit": bit})
            before |= bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """The audit's rows from ``part, mask, lab, n``: every order and step of every part."""
    n, lab = F.col("n"), F.col("lab")
    cells = (counts.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(n * lab.bitwiseAND(1)).alias("good"),
                                                F.sum(n * F.shiftright(lab, 1)).alias("toxic"))
             .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))  # 32 at most
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order: string, step: int, before: int, bit: int>>")
    s = cells.select("part", "cells", F.explode(steps).alias("s")).select("part", "cells", "s.*")

    def total(value, where) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(where(c["mask"]), value(c)).otherwise(0))

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    here = lambda m: fails(m) & ~gone(m)
    return s.select(
        "part", "filter_order", "step",
        total(lambda c: c["n"], lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(lambda c: c["n"], here).alias("removed"),
        total(lambda c: c["n"], lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda c: c["n"], lambda m: m == F.col("bit")).alias("unique_fails"),
        total(lambda c: c["good"], here).alias("good_lost"),
        total(lambda c: c["toxic"], here).alias("toxic_lost"),
        # a document is removed by a filter in 120 / (filters that it fails) of the orders
        total(lambda c: (c["n"] * F.lit(120) / F.bit_count(c["mask"])).cast("long"), fails).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, documents: str, labels: str) -> DataFrame:
    return interactions(stored(counters(spark, documents, spark.read.parquet(labels)), "counters"))


OP13_SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), m AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN d.doc_id > least THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT chr(65 + i::INT) AS letter, (1 << i::INT)::INT AS bit FROM range(5) t(i)
), o AS (
  SELECT '' AS filter_order, 0 AS before, 0 AS bit, 0 AS used, 0 AS step
  UNION ALL
  SELECT o.filter_order || f.letter, o.used, f.bit, o.used | f.bit, o.step + 1 FROM o, f WHERE (o.used & f.bit) = 0
), s AS (
  SELECT whole.filter_order, o.step, o.before, o.bit
  FROM o JOIN o whole ON whole.step = 5 AND o.step > 0 AND o.filter_order = left(whole.filter_order, o.step)
)
SELECT part, filter_order, step::INT AS step,
       coalesce(sum(n) FILTER ((mask & (before | bit)) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before) <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER ((mask & bit) <> 0 AND (mask & before) = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER ((mask & bit) <> 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""
