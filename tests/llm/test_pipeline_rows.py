"""Which rows the pipeline's stages keep, with ids that are reused or null."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from habiflow.llm import mixing, simhash


def _text(rng, n=60):
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


def _near(a, b):
    fp = lambda t: simhash.fingerprint(simhash.shingle_hashes(t))
    return (fp(a) ^ fp(b)).bit_count() <= 4


@pytest.fixture(scope="module")
def reused():
    """Id 1 and null ids each on many unrelated texts, copies of them with other ids, repeated rows."""
    rng = np.random.default_rng(11)
    hot, loose, own = ([_text(rng) for _ in range(12)] for _ in range(3))
    out = [(1, t) for t in hot] + [(None, t) for t in loose] + [(10 + k, t) for k, t in enumerate(own)]
    out += [(1, hot[0]), (None, loose[0])]  # repeated rows
    out += [(50, hot[1]), (0, hot[2])]  # copies: the smaller id names the group
    out += [(None, hot[3]), (None, own[0]), (60, loose[1])]  # null ids never stand before named ones
    out += [(None, t.upper()) for t in loose[2:5]]  # near copies without any id
    out += [(1, hot[4].upper()), (None, None), (None, "")]
    return out


def test_dedup_keeps_one_row_of_each_group(spark, make_docs, reused):
    groups = []
    for row in reused:
        near = [g for g in groups if any(_near(row[1], r[1]) for r in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [row]]
    for rows in (reused, reused[::-1]):
        got = [(r["doc_id"], r["text"]) for r in P.simhash_near_dedup(spark, make_docs(rows).repartition(5), "").collect()]
        assert len(got) == len(groups)
        for g in groups:
            kept = [r for r in got if r in g]
            assert len(kept) == 1
            ids = [i for i, _ in g if i is not None]
            assert kept[0][0] == (min(ids) if ids else None)
        if rows is reused:
            first = Counter(got)
    assert Counter(got) == first


def test_dedup_of_repeated_rows_does_not_depend_on_their_order(spark):
    some = [(1, "one two three", k, f"s{k}") for k in range(20)]
    kept = {tuple(P.simhash_near_dedup(spark, spark.createDataFrame(x, "doc_id long, text string, n_chars int, source string").repartition(4), "").first())
            for x in (some, some[::-1])}
    assert len(kept) == 1


def test_mixing_decides_row_by_row(spark, sf_small, make_docs, reused, monkeypatch):
    """Reused and null ids: each text goes by its own rate, whatever the other rows of the id have."""
    def rates(docs, labels, **_):
        d = docs.select("doc_id", mixing.text_hash().alias("_h")).distinct()
        return d.withColumn("rate", F.pmod("_h", F.lit(2)).cast("double")).withColumn("p_clean", F.lit(0.0))

    monkeypatch.setattr(mixing, "mixed", rates)
    df = make_docs(reused)
    odd = Counter((r["doc_id"], r["text"]) for r in df.filter(F.pmod(mixing.text_hash(), F.lit(2)) == 1).collect())
    got = Counter((r["doc_id"], r["text"]) for r in P.mixing_to_targets(spark, df, sf_small).collect())
    assert got == odd
    for i in (None, 1):
        assert 0 < sum(n for (j, _), n in got.items() if j == i) < sum(j == i for j, _ in reused)
