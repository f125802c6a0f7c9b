"""Operator 12: ranked lexical search by a pipeline of term owners.

The query terms are dealt to four owners by weight, the rarest terms to the
first.  An index row holds the terms of one document that one owner has, with
what each adds to a score for a unit of weight, and the index is written
partitioned by owner.  Documents stand in blocks of 4,096 in scan order.  For
each block an item sets out with a bundle: its terms and an empty sparse
accumulator (document positions and integer scores).  The bundles pass the
owners in turn; at each, bundles and the owner's rows of the same block meet in
a cogroup that adds the contributions of that owner's terms.  What a term adds
in a block is never sent anywhere, so a term that most documents hold costs its
postings once, not once an item.

After each owner an item's floor is the twentieth best score so far.  Scores
only grow, and by no more than 1,000,000 for each unit of the weight that is
left; accumulators that can't reach the floor any more are dropped, and
documents that no accumulator has yet don't enter once the weight left is too
small.  Both are exact.  Last come the twenty best of each block and then of
each item.

The query vocabulary is sent to tasks in slices of at most ``VOCABULARY``
terms; a larger one takes more passes over the documents.  Items beyond
``ITEMS`` are dealt to groups, and each block meets each group by itself.

Defined cases: a null text has no terms; rows of items with the same id are one
item with the terms of all; a null item id is one item; an item without terms
or hits has no rows; documents that repeat an id are ranked each by itself,
among equal scores by ascending doc_id, null last, equal ids in scan order; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.common import stage_path, stored

TOP = 20
BLOCK = 4096
ITEMS = 1024
VOCABULARY = 200_000
# least weight of a term of each owner but the last: in 1 %, 10 % and half of the documents
OWNERS = (4600, 2300, 700)
LAST = len(OWNERS)
UNIT = 1_000_000  # more than a term adds to a score for a unit of weight

# letters and digits stay, A-Z in lower case, other ASCII characters become spaces, bytes of further characters stay
_FOLD = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

_FORWARD = "row long, doc_id long, n long, terms array<int>, tfs array<int>"
_INDEX = "owner int, block long, pos int, doc_id long, terms array<int>, adds array<long>"
_BUNDLE = ("block long, part int, item_id {item}, terms array<int>, weights array<long>, owners array<int>, bar long, "
           "pos array<int>, scores array<long>, best array<long>")


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, times``."""
    kind = items.schema["item_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
            ids = b.column("item_id").take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            yield pa.RecordBatch.from_arrays([ids, pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"])

    one = items.select("item_id", "text").mapInArrow(run, f"item_id {kind.simpleString()}, term binary")
    return one.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def forward(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """A row for each document with terms: its place, its number of terms, and ids and counts of the ``known`` ones."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = sent.value
        for b in batches:
            lengths, sizes, found, times = [], [], [], []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                w = terms(t)
                lengths.append(len(w))
                hits = [(ids[x], k) for x, k in Counter(w).items() if x in ids]
                sizes.append(len(hits))
                found += [i for i, _ in hits]
                times += [k for _, k in hits]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            out = pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], names=["row", "doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(np.array(lengths, np.int64) > 0))

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, _FORWARD))


def owned(rows: DataFrame, first: int, owner_of: list[int], n_docs: int, n_terms: int) -> DataFrame:
    """The index rows of ``forward`` rows; ``owner_of`` is of the terms from ``first`` on.  The last owner has a row for every document."""
    sent = rows.sparkSession.sparkContext.broadcast(np.array(owner_of, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = b.column("row").to_numpy()
            m = np.array([100 - 25 + 25 * n * n_docs // n_terms for n in b.column("n").to_pylist()], np.int64)
            sizes = np.diff(b.column("terms").offsets.to_numpy())
            doc = np.repeat(np.arange(len(row)), sizes)
            term = b.column("terms").flatten().to_numpy()
            tf = b.column("tfs").flatten().to_numpy().astype(np.int64)
            adds = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
            owner = sent.value[term - first]
            for o in range(LAST + 1):
                at = np.flatnonzero(owner == o)
                n = np.bincount(doc[at], minlength=len(row))
                has = np.flatnonzero(n) if o < LAST else np.arange(len(row))
                offsets = pa.array(np.concatenate(([0], np.cumsum(n[has]))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(has), o), pa.int32()), pa.array(row[has] // BLOCK), pa.array(row[has] % BLOCK, pa.int32()),
                     b.column("doc_id").take(pa.array(has)), pa.ListArray.from_arrays(offsets, pa.array(term[at], pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(adds[at], pa.int64()))],
                    names=["owner", "block", "pos", "doc_id", "terms", "adds"])

    return rows.mapInArrow(run, _INDEX)


class _Postings:
    """An owner's rows of one block by term."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.combine_chunks()
        lists = rows.column("terms").combine_chunks()
        self.pos, self.doc_id = rows.column("pos").to_numpy(), rows.column("doc_id")
        pos = np.repeat(self.pos, pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
        term = lists.flatten().to_numpy()
        order = np.argsort(term, kind="stable")
        self._term, self._pos = term[order], pos[order]
        self._adds = rows.column("adds").combine_chunks().flatten().to_numpy()[order]

    def add(self, score: np.ndarray, term: int, weight: int) -> None:
        a, b = np.searchsorted(self._term, [term, term + 1])
        score[self._pos[a:b]] += weight * self._adds[a:b]


def _scored(bundles: pa.Table, postings: _Postings, owner: int) -> Iterator[tuple[dict, np.ndarray, np.ndarray, int]]:
    """Each bundle with its positions and scores after this owner, and what later owners can add to a score at most."""
    for x in bundles.to_pylist():
        weight, owners = np.array(x["weights"], np.int64), np.array(x["owners"], np.int64)
        left, later = int(weight[owners >= owner].sum()) * UNIT, int(weight[owners > owner].sum()) * UNIT
        score = np.zeros(BLOCK, np.int64)
        score[x["pos"]] = x["scores"]
        may = score > 0 if left < x["bar"] else np.ones(BLOCK, bool)
        for i in np.flatnonzero(owners == owner).tolist():
            postings.add(score, x["terms"][i], x["weights"][i])
        pos = np.flatnonzero(may & (score > 0) & (score + later >= x["bar"]))
        yield x, pos, score[pos], later


def _stage(owner: int, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(bundles: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for x, pos, score, later in _scored(bundles, _Postings(rows), owner):
            if len(pos) or later >= x["bar"]:
                out.append(x | {"pos": pos, "scores": score, "best": np.sort(score)[-TOP:]})
        return pa.Table.from_pylist(out, schema)

    return run


def _last_stage(schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best of the block, by score, doc_id and place."""
    def run(bundles: pa.Table, rows: pa.Table) -> pa.Table:
        postings, out = _Postings(rows), []
        at = np.zeros(BLOCK, np.int64)
        at[postings.pos] = np.arange(len(postings.pos))
        none = postings.doc_id.is_null().to_numpy()
        doc_id = postings.doc_id.fill_null(0).to_numpy()
        for x, pos, score, _ in _scored(bundles, postings, LAST):
            r = at[pos]
            for k in np.lexsort((pos, doc_id[r], none[r], -score))[:TOP].tolist():
                out.append({"item_id": x["item_id"], "doc_id": None if none[r[k]] else int(doc_id[r[k]]),
                            "score": int(score[k]), "row": x["block"] * BLOCK + int(pos[k])})
        return pa.Table.from_pylist(out, schema)

    return run


def _bars(bundles: DataFrame, top: int) -> DataFrame:
    """``_item, bar``: the score that the ``top``-th best document of an item has reached."""
    w = Window.partitionBy("item_id").orderBy(F.desc("score"))
    return (bundles.select("item_id", F.explode("best").alias("score")).withColumn("k", F.row_number().over(w))
            .filter(f"k = {top}").select(F.col("item_id").alias("_item"), F.col("score").alias("bar")))


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``TOP`` documents of each item."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType.simpleString()
    result = f"item_id {item_type}, doc_id long, score long, row long"
    wanted = stored(item_terms(items), "item_terms")
    vocabulary = stored(wanted.select("term").distinct(), "vocabulary")
    slices = max(1, -(-vocabulary.count() // VOCABULARY))

    # a slice of the vocabulary at a time: forward rows, statistics, weights, owners, index rows
    index, weights = (stage_path(spark, f"llm/{name}-{uuid.uuid4().hex}") for name in ("index", "weights"))
    first = n_docs = n_terms = 0
    for s in range(slices):
        known = [bytes(r[0]) for r in vocabulary.filter(F.pmod(F.xxhash64("term"), F.lit(slices)) == s).collect()]
        rows = stored(forward(docs, {t: first + i for i, t in enumerate(known)}), "forward")
        if not s:
            n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
            if not n_docs or not known:
                return spark.createDataFrame([], result).select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
        df = {r[0]: r[1] for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(first + i, 0) + 1))) for i in range(len(known))]
        owner = [sum(w < least for least in OWNERS) for w in weight]
        (spark.createDataFrame([(bytearray(t), first + i, weight[i], owner[i]) for i, t in enumerate(known)],
                               "term binary, id int, weight long, owner int").write.mode("append").parquet(weights))
        owned(rows, first, owner, n_docs, n_terms).write.mode("append").partitionBy("owner").parquet(index)
        first += len(known)
    postings = spark.read.schema(_INDEX).parquet(index)
    weighed = spark.read.schema("term binary, id int, weight long, owner int").parquet(weights)

    per_item = (wanted.join(weighed, "term").groupBy("item_id")
                .agg(F.collect_list(F.struct("id", (F.col("weight") * F.col("times")).alias("weight"), "owner")).alias("t"))
                .select("item_id", F.col("t.id").alias("terms"), F.col("t.weight").alias("weights"), F.col("t.owner").alias("owners")))
    per_item = stored(per_item, "items")
    groups = max(1, -(-per_item.count() // ITEMS))
    per_item = per_item.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int"))

    def owner_rows(owner: int) -> DataFrame:
        return (postings.filter(F.col("owner") == owner).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
                .select(F.col("block").alias("_block"), "_part", "pos", "doc_id", "terms", "adds"))

    # every block meets every item: the items are dealt to all salts, a block to one
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = (postings.filter(F.col("owner") == LAST).select("block").distinct()
              .withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")))
    bundles = (blocks.join(per_item.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "salt")
               .select("block", "part", "item_id", "terms", "weights", "owners", F.lit(0).cast("long").alias("bar"),
                       F.array().cast("array<int>").alias("pos"), F.array().cast("array<long>").alias("scores"),
                       F.array().cast("array<long>").alias("best")))
    ddl = _BUNDLE.format(item=item_type)
    for owner in range(LAST + 1):
        left = bundles.groupBy("block", "part")
        right = owner_rows(owner).groupBy("_block", "_part")
        if owner == LAST:
            found = left.cogroup(right).applyInArrow(_last_stage(_arrow(result)), result)
            break
        bundles = stored(left.cogroup(right).applyInArrow(_stage(owner, _arrow(ddl)), ddl), f"bundles{owner}")
        bars = _bars(bundles, TOP)
        bundles = (bundles.drop("bar").join(bars, F.col("item_id").eqNullSafe(F.col("_item")), "left")
                   .withColumn("bar", F.coalesce("bar", F.lit(0)))
                   .select([f.name for f in _arrow(ddl)]))
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(w)).filter(f"rank <= {TOP}")
            .select("item_id", "rank", "doc_id", "score"))


def op12_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked_search(docs, items)


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), d AS (
  SELECT row_id, doc_id, len(w)::BIGINT AS n, w FROM t WHERE len(w) > 0
), p AS (
  SELECT row_id, term, count(*)::BIGINT AS tf FROM (SELECT row_id, unnest(w) AS term FROM d) GROUP BY row_id, term
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d
), q AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term), totals
), s AS (
  SELECT q.item_id, d.row_id, d.doc_id,
         sum(q.times * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * docs) // terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (row_id), totals
  GROUP BY q.item_id, d.row_id, d.doc_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST, row_id) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
"""
