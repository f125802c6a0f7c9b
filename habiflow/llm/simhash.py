"""Operator 8: SimHash near-duplicates by a byte-position index with count filtering.

A fingerprint of 64 bits is eight positional bytes.  Two fingerprints that
differ in at most four bits differ in at most four bytes, so at least four
positional bytes agree.  The index posts fingerprints by position and byte.
Under one order of all positional bytes, the rarest first, two fingerprints
that share four of eight share one of the five rarest of each, so five postings
a fingerprint find every pair and keep the commonest bytes' lists, which would
be longest, from being paired.  Within a posting list the shared positional
bytes of a pair are tallied over all eight positions; pairs that reach the
guaranteed minimum are verified by their bit distance.

Groups of copies: equal fingerprints are one index entry.  A posting list is
cut into blocks by hash and every pair of blocks is its own task, so no task
gathers a list; each task reports a spanning forest of the links it finds, not
the pairs, which keeps the components and bounds the output by the entries
read.  A list holds about 1/400 of the different fingerprints, so the tallies
grow with their square: a million of them take one core about 85 seconds.

Defined cases: a null text has no words; a text without words has the
fingerprint zero and is linked like any other; with fewer words than a shingle
the whole sequence is one shingle; repeated rows each keep their row; null
doc_ids keep their row but cannot name a component others share (the smallest
doc_id that is not null does; null if there is none); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow.llm.common import cut_lineage, stored
from habiflow.llm.components import components

BYTES = 8
SEED = 42
_VALUES = np.arange(256, dtype=np.uint8)
# bit k of each byte value
_BITS = ((_VALUES[:, None] >> np.arange(8, dtype=np.uint8)) & 1).astype(np.int64)


def shingle_hashes(text: str | None, shingle: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``shingle`` words, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and \x20\x09-\x0D only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if over half of the hashes set it; counted byte by byte."""
    n, out = len(hashes), 0
    if not n:
        return 0
    by_byte = hashes.astype("<u8").view(np.uint8).reshape(n, BYTES)
    for p in range(BYTES):
        ones = np.bincount(by_byte[:, p], minlength=256) @ _BITS
        for k in np.flatnonzero(2 * ones > n).tolist():
            out |= 1 << (8 * p + k)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, *keep: str) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's 64 bits as a signed long) and the columns ``keep``."""
    d = docs.select(F.col("doc_id").cast("long"), "text", *keep)
    schema = "doc_id long, fp long" + "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(shingle_hashes(t, shingle)) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64)), *[b.column(c) for c in keep]],
                                             names=["doc_id", "fp", *keep])

    return d.mapInArrow(run, schema)


def _forest(u: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links u[i]-v[i]."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(u.tolist(), v.tolist()):
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[ra] = rb
            out.append((a, b))
    return out


def verified_links(left: np.ndarray, right: np.ndarray, max_bits: int, min_bytes: int) -> list[tuple[int, int]]:
    """Forest of the pairs of ``left`` x ``right`` that pass the count filter and the bit distance.

    The pairs are formed a slice of ``left`` at a time and folded into the
    forest so far, so memory holds one slice.
    """
    links: list[tuple[int, int]] = []
    a, b = left.view(np.uint64), right.view(np.uint64)
    by_byte = b.view(np.uint8).reshape(-1, BYTES)
    for at in range(0, len(a), 256):
        x = a[at:at + 256]
        mine = x.view(np.uint8).reshape(-1, BYTES)
        tally = np.zeros((len(x), len(b)), np.uint8)
        for p in range(BYTES):
            tally += mine[:, p, None] == by_byte[None, :, p]
        i, j = np.nonzero(tally >= min_bytes)
        near = np.bitwise_count(x[i] ^ b[j]) <= max_bits
        u, v = left[at + i[near]], right[j[near]]
        if not len(u):
            continue
        old = np.array(links, np.int64).reshape(-1, 2)
        links = _forest(np.concatenate((old[:, 0], u[u != v])), np.concatenate((old[:, 1], v[u != v])))
    return links


def byte_column(p: int) -> Column:
    """Byte ``p`` of ``fp``, from 0 to 255."""
    return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(0xFF)


def postings(entries: DataFrame, most: int) -> DataFrame:
    """``fp, p, byte``: the ``most`` rarest positional bytes of each fingerprint, by their counts over all."""
    one = entries.select(F.explode(F.array(*[F.struct(F.lit(p).alias("p"), byte_column(p).alias("byte")) for p in range(BYTES)])).alias("x"))
    counted = one.groupBy("x.p", "x.byte").agg(F.count("*").alias("n")).collect()  # 2,048 rows at most
    counts = [0] * (256 * BYTES)
    for r in counted:
        counts[256 * r["p"] + r["byte"]] = r["n"]
    known = F.from_json(F.lit(json.dumps(counts)), "array<bigint>")
    ranked = F.sort_array(F.array(*[F.struct(F.element_at(F.col("_n"), (256 * p + 1 + byte_column(p)).cast("int")).alias("n"),
                                             F.lit(p).alias("p"), byte_column(p).alias("byte")) for p in range(BYTES)]))
    return (entries.select("fp", known.alias("_n")).select("fp", F.explode(F.slice(ranked, 1, most)).alias("x"))
            .select("fp", "x.p", "x.byte"))


def near_links(entries: DataFrame, max_bits: int = 4, block: int = 2000) -> DataFrame:
    """``u, v``: links between distinct fingerprints ``fp`` that keep their components.

    ``block`` bounds what a task holds of a posting list; lists beyond it are
    split into blocks, and all pairs of blocks are compared.
    """
    min_bytes = BYTES - max_bits
    if not 0 < min_bytes:
        raise ValueError("max_bits must be below the number of positional bytes")
    # a checkpointed table may lie in a few partitions
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = stored(postings(entries.select("fp").repartition(parts, "fp"), BYTES - min_bytes + 1), "postings")
    lists = posted.groupBy("p", "byte").agg(F.count("*").alias("n")).filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = (posted.join(F.broadcast(lists.select("p", "byte", "blocks")), ["p", "byte"])  # 2,048 rows at most
            .withColumn("b", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
            # block b meets every block: as the left one those from b on, as the right one those before
            .withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("p", "byte", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "fp"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        fp, b = group["fp"].to_numpy(np.int64), group["b"].to_numpy()
        found = verified_links(fp[b == i], fp[b == j], max_bits, min_bytes)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return rows.groupBy("p", "byte", "i", "j").applyInPandas(compare, "u long, v long").distinct()


def rooted(entries: DataFrame, max_bits: int = 4) -> DataFrame:
    """``entries``, a row for each ``fp``, with the ``root`` of its component."""
    roots = components(near_links(entries.select("fp"), max_bits))
    return entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    d = stored(fingerprints(docs, shingle), "fingerprints")
    linked = rooted(cut_lineage(d.groupBy("fp").agg(F.min("doc_id").alias("first"))), max_bits)
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(names, "root").select("fp", "component_id")
    return d.join(named, "fp").select("doc_id", "fp", "component_id")


def row_key() -> list[Column]:
    """``_none, _id, _h1, _h2``, which tell rows of different ids or texts apart; none is null."""
    i = F.col("doc_id").cast("long")
    return [i.isNull().alias("_none"), F.coalesce(i, F.lit(0)).alias("_id"),
            F.xxhash64("text", F.lit("a")).alias("_h1"), F.xxhash64(F.lit("b"), "text").alias("_h2")]


KEY = ("_none", "_id", "_h1", "_h2")


def first_rows(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The ``row_key`` of the row that stays of each component: that of the smallest id, if it has any, then of the smallest hash."""
    d = stored(fingerprints(docs.select("doc_id", "text", *row_key()), shingle, *KEY), "fingerprints")
    linked = rooted(cut_lineage(d.groupBy("fp").agg(F.min(F.struct(*KEY)).alias("row"))), max_bits)
    return linked.groupBy("root").agg(F.min("row").alias("row")).select("row.*")


def op8_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
