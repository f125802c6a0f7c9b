"""Operator 4: suffix-array dedup by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``SPAN`` bytes over it also starts earlier in the
corpus.  Equal strings have the same anchor: the smallest hash of their runs
of ``GRAM`` bytes, at the same offset.  So a text's windows of SPAN bytes fall
into segments (neighbouring windows with one anchor), and only segments with a
common anchor can share a window:

1. Each batch cuts its texts into segments and settles those that repeat in
   it; one row of each different segment goes on, so a passage that a third of
   the corpus has is one row a batch.
2. Rows meet by anchor.  A segment that another row has whole and earlier is
   removed; anchors in one place only are done with.
3. Anchors with different segments (the edges of passages) are dealt into
   buckets of strings.  In a bucket each shard of strings gets a suffix array
   and its Burrows-Wheeler transform; the transforms are merged by refining
   their interleave, up to eight symbols a round, without sorting the suffixes
   of the union.  Neighbours in one block share as many bytes as were read, and
   suffixes alone in theirs are left out, so the blocks after SPAN bytes are the
   repeated intervals.  An anchor with more segments, or bytes, than a bucket
   can hold is cut into single windows, of which the equal ones meet and all
   but the first go, so no bucket grows with a passage's copies.
4. The removed windows of a text are joined to it.

Defined cases: a null text counts as empty; texts under SPAN bytes lose
nothing; a null doc_id comes first; rows with one doc_id go by the hash of
their text, and rows that repeat both count as one document with one result
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.common import stored, text_or_empty

SPAN = 100
GRAM = 40
LEADING = 7   # symbols that fit into one number
# small enough for a core's cache, where a round is several times as fast
BUCKET_BYTES = 200_000
SHARD_BYTES = 100_000
HOT_SEGMENTS = 4000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


@functools.lru_cache(2)
def _powers_to(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_to(base, 1 << 16)[:n] if n <= 1 << 16 else _powers_to.__wrapped__(base, n)


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of ``gram`` bytes: a polynomial by prefix sums, mixed."""
    n = len(buf)
    sums = np.concatenate((np.zeros(1, _U), np.cumsum((buf.astype(_U) + _U(1)) * _powers(_INVERSE, n))))
    h = (sums[gram:] - sums[:-gram]) * _powers(_BASE, n)[: n - gram + 1]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _sliding(least: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``least`` (minimum or maximum) of each run of ``width`` values."""
    k, n = 1, len(x) - width + 1
    while 2 * k <= width:
        x = least(x[:-k], x[k:])
        k *= 2
    return least(x[:n], x[width - k:][:n]) if k < width else x


def segments(buf: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor, start and number of windows of each segment of a text of at least ``span`` bytes, and whether its
    anchor stands in it twice (then it may hold one window twice)."""
    h = gram_hashes(buf, gram)
    width = span - gram + 1
    least = _sliding(np.minimum, h, width)
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    start = np.concatenate(([0], cut))
    anchor, n = least[start], np.diff(np.concatenate((start, [len(least)])))
    # runs that are the smallest of some window are few; an anchor that stands twice in its segment is two of them
    edge = np.zeros(width - 1, _U)
    smallest = np.sort(h[h == _sliding(np.maximum, np.concatenate((edge, least, edge)), width)])
    again = smallest[1:][smallest[1:] == smallest[:-1]]
    twice = np.isin(anchor, again) if len(again) else np.zeros(len(anchor), bool)
    for k in np.flatnonzero(twice).tolist():
        twice[k] = np.count_nonzero(h[start[k]:start[k] + n[k] + width - 1] == anchor[k]) > 1
    return anchor, start, n, twice


SEGMENT = "doc_id long, h long, start long, n long, anchor long, seg long, twice boolean"


def cut_texts(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """The segments of ``docs(doc_id, h, text)``; ``seg`` is null for those that repeat in their batch (not first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, hs = b.column("doc_id"), np.array(b.column("h").to_pylist(), np.int64)
            rows, anchors, starts, counts, segs, twices = [], [], [], [], [], []
            for r, t in enumerate(b.column("text").to_pylist()):
                data = t.encode("utf-8", "surrogatepass")
                if len(data) < span:
                    continue
                a, s, n, w = segments(np.frombuffer(data, np.uint8), span, gram)
                twices.append(w)
                rows.append(np.full(len(s), r))
                anchors.append(a.view(np.int64))
                starts.append(s)
                counts.append(n)
                segs.append(np.array([xxhash.xxh3_64_intdigest(data[x:x + c + span - 1]) for x, c in zip(s.tolist(), n.tolist())], _U).view(np.int64))
            if not rows:
                continue
            row, anchor, start, n, seg, twice = map(np.concatenate, (rows, anchors, starts, counts, segs, twices))
            # nulls first, then by id, as the corpus is ordered
            plain = np.array([-1 << 63 if x is None else x for x in ids.to_pylist()], np.int64)
            order = np.lexsort((start, hs[row], plain[row], seg, anchor))
            row, anchor, start, n, seg, twice = (x[order] for x in (row, anchor, start, n, seg, twice))
            again = np.concatenate(([False], (anchor[1:] == anchor[:-1]) & (seg[1:] == seg[:-1])))
            # a repeated row of one document is no repeat
            same = np.concatenate(([False], (plain[row][1:] == plain[row][:-1]) & (hs[row][1:] == hs[row][:-1]) & (start[1:] == start[:-1])))
            keep = ~(again & same)
            row, anchor, start, n, seg, twice, again = (x[keep] for x in (row, anchor, start, n, seg, twice, again))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)), pa.array(hs[row]), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int64)),
                 pa.array(anchor), pa.array(seg, mask=again), pa.array(twice)],
                names=["doc_id", "h", "start", "n", "anchor", "seg", "twice"])

    return docs.mapInArrow(run, SEGMENT)


# --- shards ------------------------------------------------------------------


def leading(text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` symbols from each place on as one number (``k`` up to 7), and whether a string ends in them."""
    n = len(text)
    padded = np.concatenate((text.astype(np.int64), np.zeros(k, np.int64)))
    key = padded[:n].copy()
    ended = padded[:n] == 0
    for i in range(1, k):
        key = key * 257 + padded[i:i + n]
        ended |= padded[i:i + n] == 0
    return key, ended


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of symbols ``text`` by their first ``depth`` symbols at least: seven at once, then
    doubling, which sorts only suffixes that are still equal."""
    n, k = len(text), LEADING
    key, _ = leading(text, k)
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
    # the rank of a suffix is the first place of those equal to it
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while k < depth:
        places = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(places):
            break
        own = order[places]
        ahead = own + k
        key = rank[own] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[places] = own
        first = np.concatenate(([True], key[1:] != key[:-1]))
        new[places] = first
        rank[own] = np.maximum.accumulate(np.where(first, places, 0))
        k *= 2
    return order


def transform(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each suffix, in their order (0 before the start of a string), and the place in that order
    of the suffix one symbol longer."""
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return text[order - 1], place[order - 1]


def merge_transforms(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of which others have the same first ``depth`` symbols: their place in the concatenated parts, and
    their block, in merged order.

    A part is a transform's symbols and places, and the number of its suffixes' first symbols, with whether a
    string ends in these.  The parts are merged by those first; then a round reads the symbols in the order so far
    and deals the suffixes stably by them: their order by one more leading symbol, or by eight, four or two, as
    numbers that tell runs of symbols apart.  Suffixes are in one block as long as their leading symbols are equal
    and no string (symbol 0 ends one) has ended.  One that is alone in its block is settled, and so are all longer
    ones from it on: it takes no part in later rounds.
    """

    def shared(at: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more = ~(new & np.append(new[1:], True))
        return at[more], np.cumsum(new, dtype=np.int32)[more]

    start = np.cumsum([0, *[len(p[0]) for p in parts[:-1]]])
    symbols, before, key, ended = map(np.concatenate, zip(*[(p[0], p[1] + np.int32(s), *p[2:]) for p, s in zip(parts, start)]))
    steps, step = [(1, symbols, before)], 1
    while step < 8:
        _, symbols, before = steps[-1]
        ahead = symbols[before].astype(np.int64)
        known, symbols = np.unique(np.where((symbols == 0) | (ahead == 0), 0, ahead << 16 | symbols), return_inverse=True)
        if len(known) > 1 << 16:
            break
        step *= 2
        steps.append((step, symbols.astype(np.uint16), before[before]))
    at = np.argsort(key, kind="stable").astype(np.int32)
    c = key[at]
    at, block = shared(at, np.concatenate(([True], c[1:] != c[:-1])) | ended[at])
    left = depth - min(depth, LEADING)
    for step, symbols, before in reversed(steps):
        while left >= step and len(at):
            left -= step
            c = symbols[at]
            order = np.argsort(c, kind="stable")
            c, old, at = c[order], block[order], before[at[order]]
            at, block = shared(at, np.concatenate(([True], (c[1:] != c[:-1]) | (old[1:] != old[:-1]))) | (c == 0))
    return at, block


def repeated_windows(strings: list[bytes], span: int = SPAN, shard_bytes: int = SHARD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, offset and block of every window of ``span`` bytes that occurs more than once in ``strings``."""
    shards, size = [[]], 0
    for k, s in enumerate(strings):
        if size > shard_bytes:
            shards.append([])
            size = 0
        shards[-1].append(k)
        size += len(s)
    parts, owners, offsets = [], [], []
    for own in shards:
        text = np.concatenate([np.append(np.frombuffer(strings[k], np.uint8).astype(np.uint16) + 1, np.uint16(0)) for k in own])
        lengths = np.array([len(strings[k]) + 1 for k in own])
        order = suffix_array(text, span)
        key, ended = leading(text, min(span, LEADING))
        parts.append((*transform(text, order), key[order], ended[order]))
        owners.append(np.repeat(np.array(own), lengths)[order])
        offsets.append((np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[order])
    at, block = merge_transforms(parts, span)
    return np.concatenate(owners)[at], np.concatenate(offsets)[at], block


def later_windows(strings: list[bytes], rank: np.ndarray, span: int = SPAN) -> list[tuple[int, int, int]]:
    """(string, first offset, windows): runs of windows that occur before, by ``rank`` of the string, then offset."""
    owner, offset, block = repeated_windows(strings, span)
    order = np.lexsort((offset, rank[owner], block))
    again = np.concatenate(([False], block[order][1:] == block[order][:-1]))
    owner, offset = owner[order][again], offset[order][again]
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    if not len(owner):
        return []
    start = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))))
    n = np.diff(np.concatenate((start, [len(owner)])))
    return list(zip(owner[start].tolist(), offset[start].tolist(), n.tolist()))


COVERED = "doc_id long, h long, start long, n long"


def dealt(parts: DataFrame, span: int = SPAN, bucket_bytes: int = BUCKET_BYTES, hot_segments: int = HOT_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Of ``parts(doc_id, h, anchor, start, bytes)`` the strings to merge with their ``bucket``, and the repeated
    windows of the anchors that are cut into single ones."""
    held = parts.groupBy("anchor").agg(F.count("*").alias("_c"), F.sum(F.length("bytes")).alias("_s"))
    hot = held.filter((F.col("_c") > hot_segments) | (F.col("_s") > 2 * span * hot_segments)).select("anchor")
    # equal windows have two equal hashes, and one anchor: all of them are here
    single = (parts.join(hot, "anchor", "left_semi")
              .withColumn("o", F.explode(F.expr(f"sequence(0, length(bytes) - {span})")))
              .select("doc_id", "h", (F.col("start") + F.col("o")).alias("start"), F.expr(f"substring(bytes, o + 1, {span})").alias("bytes"))
              .select("doc_id", "h", "start", F.xxhash64("bytes").alias("k"), F.xxhash64(F.lit(5), "bytes").alias("k2")))
    equal = Window.partitionBy("k", "k2").orderBy(F.col("doc_id").asc_nulls_first(), "h", "start")
    again = single.withColumn("_r", F.row_number().over(equal)).filter("_r > 1").select("doc_id", "h", "start", F.lit(1).cast("long").alias("n"))
    plain = parts.join(hot, "anchor", "left_anti").select("doc_id", "h", "start", "bytes", F.col("anchor").alias("k"))
    size = parts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    strings = plain.withColumn("bucket", F.pmod(F.xxhash64("k", F.lit(3)), F.lit(buckets)))
    return strings, again


def removed_windows(docs: DataFrame, span: int = SPAN, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
                    hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``doc_id, h, start, n``: runs of windows of ``docs(doc_id, h, text)`` that also start earlier."""
    cut = cut_texts(docs, span, gram)
    local = cut.filter("seg is null").select("doc_id", "h", "start", "n")
    by_anchor = Window.partitionBy("anchor")
    place = Window.partitionBy("anchor", "seg").orderBy(F.col("doc_id").asc_nulls_first(), "h", "start")
    rows = (cut.filter("seg is not null").withColumn("_r", F.dense_rank().over(place))
            .withColumn("_n", F.count("*").over(by_anchor))
            .withColumn("_mixed", F.min("seg").over(by_anchor) != F.max("seg").over(by_anchor))
            .filter("_n > 1 or twice"))
    rows = stored(rows, "segments")
    whole = rows.filter("_r > 1").select("doc_id", "h", "start", "n")
    edges = rows.filter("_r = 1 and (_mixed or twice)").select("doc_id", "h", "start", "n", "anchor").distinct()
    # the bytes of the edges, cut from their texts
    wanted = edges.groupBy("doc_id", "h").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("_e")).select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "_e")
    parts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")))
    parts = parts.withColumn("_b", F.encode("text", "UTF-8")).select("doc_id", "h", F.explode(F.expr(
        f"transform(_e, e -> struct(e.anchor as anchor, e.start as start, "
        f"substring(_b, cast(e.start + 1 as int), cast(e.n + {span - 1} as int)) as bytes))")).alias("e"))
    parts = stored(parts.select("doc_id", "h", "e.anchor", "e.start", "e.bytes").distinct(), "edges")
    strings, again = dealt(parts, span, bucket_bytes, hot_segments)

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("h", "ascending"), ("start", "ascending")])
        ids = t.column("doc_id")
        # nulls come last from the sort, and first in the corpus
        rank = np.arange(len(t)) - len(t) * np.array(ids.is_null().to_pylist(), np.int64)
        runs = later_windows(t.column("bytes").to_pylist(), rank, span)
        k, o, n = (np.array(x, np.int64) for x in zip(*runs)) if runs else (np.empty(0, np.int64),) * 3
        own = t.take(pa.array(k))
        start = own.column("start").to_numpy() + o
        return pa.table({"doc_id": own.column("doc_id"), "h": own.column("h"), "start": start, "n": n})

    merged = strings.groupBy("bucket").applyInArrow(merge, COVERED)
    return local.union(whole).union(again).union(merged)


def suffix_dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM, **sizes: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) for every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).withColumn("h", F.xxhash64("text"))
    gone = (removed_windows(d, span, gram, **sizes).groupBy("doc_id", "h")
            .agg(F.collect_list(F.struct("start", "n")).alias("runs")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "runs"))
    d = d.join(gone, d["doc_id"].eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                change = np.zeros(len(data) + 1, np.int64)
                for r in runs or ():
                    change[r["start"]] += 1
                    change[r["start"] + r["n"] - 1 + span] -= 1
                lost = np.cumsum(change[:-1]) > 0
                spans = int(np.count_nonzero(lost[1:] & ~lost[:-1])) + int(len(lost) > 0 and lost[0])
                kept = np.frombuffer(data, np.uint8)[~lost].tobytes() if spans else data
                out.append((len(data), int(lost.sum()), spans, kept))
            n, m, s, k = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                                              pa.array(s, pa.int64()), pa.array(k, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return d.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_dedup(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
