"""Operator 5: document fingerprints by Order MinHash.

The k-mers are runs of ``K`` words, numbered by occurrence within the text, so
a repeated one counts as often as it occurs.  A signature part takes ``L``
minimal occurrence-numbered k-mers, each under a hash of its own, puts them in
the order in which they stand in the text and hashes the tuple.  Two texts
agree in a part if they share its k-mers and have them in one order, which is
what an edit distance sees and a set of k-mers does not.  A fingerprint is
``PARTS`` parts; likeness is the share of equal parts.  DataFrame functions
only; minima are plain aggregates over exploded k-mers, in whole-stage code.

Defined cases: a null text counts as empty; a text of fewer than ``K`` words
is one k-mer, texts without a word all have one fingerprint of their own;
documents go by descending doc_id (nulls last, equal ids by text hash), after
the last one comes the first, so a lone document is its own next; repeated
rows each keep their row; an empty table gives an empty result; other columns
are ignored.  Beyond 2^24 words order is only seen modulo that many.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habiflow.llm.common import text_or_empty, words

K = 3
L = 2
PARTS = 24
_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1


def numbered_kmers(text: Column, docs: DataFrame) -> DataFrame:
    """``docs`` with ``_k``: an array of (h, occ, pos), one for each k-mer of ``text``.

    Hashes are sorted packed with their position, so equal ones form runs;
    a k-mer's number is its place in its run.
    """
    d = docs.withColumn("_w", words(text)).withColumn("_n", F.size("_w"))
    d = d.withColumn("_h", F.expr(
        f"CASE WHEN _n = 0 THEN cast(array() as array<bigint>) ELSE "
        f"transform(sequence(1, greatest(_n - {K - 1}, 1)), i -> xxhash64(slice(_w, i, {K}))) END"))
    d = d.withColumn("_b", F.expr("length(bin(size(_h)))"))
    d = d.withColumn("_s", F.expr("sort_array(transform(_h, (h, i) -> shiftleft(h, _b) | cast(i as bigint)))"))
    d = d.withColumn("_r", F.expr(
        "filter(transform(_s, (x, j) -> CASE WHEN shiftright(x, _b) <=> shiftright(get(_s, j - 1), _b) THEN -1 ELSE j END), j -> j >= 0)"))
    d = d.withColumn("_k", F.expr(
        "flatten(transform(_r, (a, q) -> transform(slice(_s, a + 1, coalesce(get(_r, q + 1), size(_s)) - a), "
        "(x, o) -> struct(cast(x & (shiftleft(1L, _b) - 1) as int) as pos, o as occ))))"))
    return d


def signatures(docs: DataFrame, text: Column, *key: str) -> DataFrame:
    """``key`` columns (which tell rows apart) and ``parts``: PARTS longs for each row of ``docs``.

    Where ``docs`` is already dealt out by some of ``key`` nothing moves.
    """
    d = numbered_kmers(text, docs).select(*key, "_h", "_k")
    d = d.select(*key, "_h", F.explode_outer("_k").alias("_x"))
    d = d.select(*key, F.xxhash64(F.expr("_h[_x.pos]"), F.col("_x.occ")).alias("_g"),
                 F.col("_x.pos").bitwiseAND(F.lit(_PLACE)).cast("long").alias("_p"))
    least = [F.min(F.when(F.col("_p").isNotNull(), F.xxhash64("_g", F.lit(j)).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.col("_p"))))
             .alias(f"_m{j}") for j in range(PARTS * L)]
    d = d.groupBy(*key).agg(*least)

    def part(i: int) -> Column:
        own = F.array_sort(F.array(*[F.struct(
            F.col(f"_m{j}").bitwiseAND(F.lit(_PLACE)).alias("p"), F.lit(j).alias("j"),
            F.col(f"_m{j}").bitwiseAND(F.lit(~_PLACE)).alias("h")) for j in range(i * L, (i + 1) * L)]))
        return F.xxhash64(F.transform(own, lambda x: F.struct(x["j"], x["h"])))

    return d.select(*key, F.array(*[part(i) for i in range(PARTS)]).alias("parts"))


def likeness(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(PARTS))


def fingerprint(parts: Column) -> Column:
    """Eight hex digits of every part."""
    return F.array_join(F.transform(parts, lambda x: F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def in_order(docs: DataFrame, rows_per_bucket: int = 2000, most: int = 128) -> DataFrame:
    """``docs`` dealt into buckets of neighbouring ids, with the order inside: ``_bucket``, ``_last``, ``doc_id``, ``text``.

    Bucket bounds are quantiles of the ids.  Every bucket also gets the first
    document of the one that follows it in order (``_last`` = 1), the final
    bucket that of the first one, so each row's next stands in its own bucket.
    """
    d = docs.select("doc_id", text_or_empty().alias("text"))
    n = d.count()
    k = min(most, max(1, math.ceil(math.sqrt(n / rows_per_bucket))))
    cuts = [i / (k * k) for i in range(1, k * k)]
    at = d.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * k * k))).first()[0] if cuts and n else None
    # the bucket is the number of bounds up to the id: every k-th first, then those in between
    bounds = F.array(*[F.lit(int(x)).cast("long") for x in at or []]) if at else F.expr("cast(array() as array<bigint>)")
    coarse = F.array(*[F.lit(int(x)).cast("long") for x in (at or [])[k - 1::k]]) if at and k > 1 else F.expr("cast(array() as array<bigint>)")
    up_to = lambda a: F.size(F.filter(a, lambda x: F.coalesce(x <= F.col("doc_id"), F.lit(False))))
    d = d.withColumn("_c", up_to(coarse))
    d = d.withColumn("_bucket", F.col("_c") * k + up_to(F.slice(bounds, F.col("_c") * k + 1, max(k - 1, 1)))).drop("_c")
    heads = d.groupBy("_bucket").agg(F.max("doc_id").alias("_head"))  # one row a bucket
    above = Window.orderBy("_bucket")
    heads = heads.select("_bucket", "_head", F.coalesce(F.lead("_bucket").over(above), F.min("_bucket").over(Window.partitionBy())).alias("_to"))
    first = d.join(F.broadcast(heads.select(F.col("_bucket").alias("_of"), "_head", "_to")),
                   (F.col("_bucket") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_head")))
    return (d.select("_bucket", F.lit(0).alias("_last"), "doc_id", "text")
            .union(first.select("_to", F.lit(1), "doc_id", "text")))


def op5_document_fingerprints(docs: DataFrame) -> DataFrame:
    order = Window.partitionBy("_bucket").orderBy("_last", F.col("doc_id").desc_nulls_last(), "_tie")
    d = in_order(docs).withColumn("_tie", F.xxhash64("text"))
    d = d.withColumn("_row", F.row_number().over(order)).withColumn("_next", F.lead("text").over(order))
    d = d.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("_next", F.lit(1), half))
    d = d.withColumn("_edited", F.when(F.col("_last") == 0, edited))
    d = d.withColumn("edited_sha256", F.sha2("_edited", 256))
    d = d.select("_bucket", "_row", "_last", "doc_id", "n_chars", "edited_sha256", F.explode(F.array(
        F.struct(F.lit(0).alias("v"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))).alias("_e"))
    d = d.select("_bucket", "_row", "_last", "doc_id", "n_chars", "edited_sha256", F.col("_e.v").alias("_v"), F.col("_e.t").alias("_t"))
    d = d.filter("_last = 0 or _v = 0")
    row = ("_bucket", "_row", "_last", "doc_id", "n_chars", "edited_sha256")
    s = signatures(d, F.col("_t"), *row, "_v")
    s = s.groupBy(*row).agg(F.first(F.when(F.col("_v") == 0, F.col("parts")), ignorenulls=True).alias("own"),
                            F.first(F.when(F.col("_v") == 1, F.col("parts")), ignorenulls=True).alias("edited"))
    s = s.withColumn("next", F.lead("own").over(Window.partitionBy("_bucket").orderBy("_row")))
    return s.filter("_last = 0").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"))
