"""Buckets of the merge stay as small however often a passage is repeated between different texts."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from habiflow.llm import suffix_dedup as S

PART = "doc_id long, h long, anchor long, start long, bytes binary"


def _parts(n, rng):
    passage = bytes(rng.integers(97, 123, 120).astype(np.uint8))
    edge = lambda: bytes(rng.integers(65, 91, 30).astype(np.uint8))
    own = [(k if k else None, k, 7, 3 * k, edge() + passage + edge()) for k in range(n)]
    long = [(n, n, 8, 0, b"xy" * 1500), (n, n, 8, 5000, b"xy" * 700)]
    few = [(n + k, 1, 9 + k // 2, 0, edge() * 4) for k in range(20)]
    return own + long + few


@pytest.mark.parametrize("n", [30, 300])
def test_no_bucket_grows_with_the_copies(spark, n):
    rows = _parts(n, np.random.default_rng(n))
    strings, again = S.dealt(spark.createDataFrame(rows, PART), bucket_bytes=1000, hot_segments=5)
    most = strings.groupBy("k").agg(F.sum(F.length("bytes")).alias("b")).agg(F.max("b")).first()[0]
    assert most <= 2 * S.SPAN * 5
    assert strings.filter("length(bytes) = 180 or length(bytes) > 1000").isEmpty()
    at = defaultdict(list)
    for doc, h, anchor, start, b in rows:
        for o in range(len(b) - S.SPAN + 1) if anchor in (7, 8) else ():
            at[b[o:o + S.SPAN]].append((-1 if doc is None else doc, h, start + o))
    want = sorted(x for w in at.values() for x in sorted(w)[1:])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["h"], r["start"]) for r in again.collect()) == want
    assert again.filter("n <> 1").isEmpty()
