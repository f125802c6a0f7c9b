import math
import random
import re
from collections import Counter

import pytest

from habiflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    """Every document's score for every item, from the formula."""
    d = [(i, Counter(split(t))) for i, t in docs]
    d = [(i, c, sum(c.values())) for i, c in d if c]
    total, n_docs = sum(n for _, _, n in d), len(d)
    df = Counter(t for _, c, _ in d for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(split(t))
    out = {}
    for item, q in wanted.items():
        found = []
        for place, (i, c, n) in enumerate(d):
            m = 100 - 25 + 25 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                    for t in q if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, place))
        out[item] = [(None if none else i, -s) for s, none, i, _ in sorted(found)[:20]]
    return {k: v for k, v in out.items() if v}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["item_id"]), r["rank"])):
        out.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(out[r["item_id"]])
    return out


def corpus(rng, n):
    words = [f"w{k}" for k in range(400)] + ["Ñu", "ñu", "ÉT", "x y"]
    weight = [1 / (k + 1) for k in range(len(words))]
    return [(i, " .\n"[i % 3].join(rng.choices(words, weight, k=rng.choice([1, 5, 40, 300])))) for i in range(n)]


@pytest.mark.parametrize(("vocabulary", "items_a_group"), [(200_000, 1024), (23, 4)])
def test_op12_against_brute_force(spark, monkeypatch, vocabulary, items_a_group):
    monkeypatch.setattr(lexical, "VOCABULARY", vocabulary)
    monkeypatch.setattr(lexical, "ITEMS", items_a_group)
    monkeypatch.setattr(lexical, "OWNERS", (2600, 1500, 600))
    rng = random.Random(7)
    docs = corpus(rng, 700)
    docs += [(i, docs[3][1]) for i in (900, 4, 4, None, 1)] + [(901, None), (902, ""), (903, "- !"), (904, "W1 " * 30_000)]
    items = [(i, docs[rng.randrange(700)][1][:200] + " w0 w1 w2") for i in range(12)]
    items += [(12, None), (13, "..."), (14, "never seen"), (None, "w7 w7 w9"), (3, "w11 more of three"), (3, "w11 more of three")]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, row int, item_id string").repartition(3)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    assert found(lexical.op12_ranked_search(d, q)) == brute(docs, items)


def test_op12_drops_accumulators_and_keeps_the_result(spark, docs, sf_small):
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = found(lexical.op12_ranked_search(docs, items))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got == want


def test_op12_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([("one", "a")], "item_id string, text string")
    assert found(lexical.op12_ranked_search(d, q)) == brute([(1, "a b")], [("one", "a")])
    assert lexical.op12_ranked_search(d.limit(0), q).columns == ["item_id", "rank", "doc_id", "score"]
    assert not lexical.op12_ranked_search(d.limit(0), q).count() and not lexical.op12_ranked_search(d, q.limit(0)).count()
    assert not lexical.op12_ranked_search(d.selectExpr("doc_id", "'' as text"), q).count()
