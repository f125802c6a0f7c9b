"""Operator 1: mixing sources to target weights by soft membership.

A labelled table trains a naive Bayes classifier (hashed words, each once a
text, against the words of all labelled texts), which gives every document
evidence for the domains.  One in five labelled documents is held out of that;
on them a temperature and a shift of each domain are fitted, which turn a
document's own evidence into its posterior.  Then each document gets a rate of
at least zero such that the expected tokens of the domains, the sum of
rate * tokens * posterior, meet
``budget`` * target in the least-squares sense.  Projected gradient descent
from rate one: a round is one aggregation of a few numbers a domain; the step
is taken in the metric of the token products of the documents with a rate, in
which its length is 1, and rates below zero are set to zero.  The rates of round k follow from the
posteriors and k short vectors, so no round keeps a table.  DataFrame
functions only.

Defined cases: a null text has no words and the domains' shares as posterior;
labels without a domain among the targets, and null ids, are not used; several
labels of an id count by the smallest domain name; without any labels every
posterior is even; without held-out ones evidence counts as it is; repeated
rows each keep their row; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow.llm.common import stored, text_or_empty, words

LABELLED_ROWS = 20_000
ROUNDS = 15
# production targets of the domains that the table labels tells apart
TARGETS = {"clean": 0.92, "low": 0.06, "toxic": 0.02}


def label_domains(labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` from quality and toxicity labels."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
                         .when(F.col("quality") == 0, "low").alias("domain"))


def _feature(word: Column) -> Column:
    """The feature of a word: case and marks at its end don't count."""
    return F.xxhash64(F.rtrim(F.lower(word), F.lit(".,;:!?")))


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], rows: int = LABELLED_ROWS,
          strength: float = 1000.0, deviations: float = 4.0) -> tuple[DataFrame, list[float]]:
    """Per feature the log of P(feature | domain) / P(feature) and the log shares of the domains.

    Trained on at most ``rows`` labelled documents, those of the smallest hash
    of their id.  The table holds the words that tell something: each has a count
    of more than ``deviations`` squared, so their number is bounded by the
    sample's words over that, and it can be broadcast.  ``strength`` words of
    all domains together smooth each domain's counts.  A count that is within
    ``deviations`` standard deviations of an even share tells nothing: without
    that, rare words would all speak for the domain with the most labels.
    """
    known = (labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.min("domain").alias("domain")))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select("doc_id", text_or_empty().alias("_t"))
    texts = texts.join(F.broadcast(sample), texts["doc_id"] == sample["_id"]).select("domain", "_t")
    counted = stored(texts.select("domain", F.explode(F.array_distinct(words(F.col("_t")))).alias("w"))
                     .groupBy("domain", _feature(F.col("w")).alias("f")).agg(F.count("*").alias("n")), "word_counts")
    total = {r["domain"]: r["n"] for r in counted.groupBy("domain").agg(F.sum("n").alias("n")).collect()}  # a row a domain
    seen = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    every = float(max(1, sum(total.values())))
    smooth = strength * F.col("all") / every
    own = {d: F.sum(F.when(F.col("domain") == d, F.col("n")).otherwise(0)) for d in domains}
    table = counted.groupBy("f").agg(F.sum("n").alias("all"), *[own[d].alias(f"n{i}") for i, d in enumerate(domains)])

    def weight(i: int, d: str) -> Column:
        even = F.col("all") * (total.get(d, 0) / every)
        told = F.abs(F.col(f"n{i}") - even) > deviations * F.sqrt(even + 1)
        return F.when(told, F.log((F.col(f"n{i}") + smooth) / (total.get(d, 0) + strength) * every / F.col("all"))).otherwise(0.0).alias(f"w{i}")

    n = sum(seen.values()) + len(domains)
    table = table.select("f", *[weight(i, d) for i, d in enumerate(domains)])
    table = table.filter(" or ".join(f"w{i} <> 0" for i in range(len(domains))))
    return table, [math.log((seen.get(d, 0) + 1) / n) for d in domains]


def held_out(labelled: DataFrame, domains: list[str], share: int = 5) -> tuple[DataFrame, DataFrame]:
    """``labelled`` without, and only, the ids of one in ``share`` by hash: the classifier never sees the latter."""
    known = labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    own = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(share)) == 0
    return known.filter(~own), known.filter(own)


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    e = [F.exp(s - top) for s in scores]
    return [x / sum(e[1:], e[0]) for x in e]


def _scaled(temper: list[float], shift: list[float], shares: list[float]) -> list[Column]:
    """The scores of the domains: the evidence ``s0, s1, ..`` of each times its temperature, and shifted."""
    return [F.lit(x + b) + F.col(f"s{i}") * F.lit(a) for i, (a, b, x) in enumerate(zip(temper, shift, shares))]


def fit_scale(held: DataFrame, shares: list[float], rounds: int = 30, strength: float = 1.0) -> tuple[list[float], list[float]]:
    """The temperatures and shifts of the domains that make the labels of ``held`` likeliest.

    ``held``: ``d`` (the domain's number), ``copies`` and the evidence ``s0,
    s1, ..``.  Newton's method from no evidence, a step being halved while it
    does not gain; a round is one aggregation of a few numbers.  ``strength``
    holds temperatures near 1 and shifts near 0: without rows they stay there.
    """
    n = len(shares)
    rest = [1.0] * n + [0.0] * n
    if not held.agg(F.sum("copies")).first()[0]:
        return rest[:n], rest[n:]
    w = F.col("copies")
    # what parameter k moves the score of domain k % n by
    by = [F.col(f"s{i}") for i in range(n)] + [F.lit(1.0)] * n
    pairs = [(j, k) for j in range(2 * n) for k in range(j, 2 * n)]

    def state(x: list[float]) -> tuple[float, list[float], list[list[float]]]:
        z = _scaled(x[:n], x[n:], shares)
        top = F.greatest(*z)
        rows = held.select("*", top.alias("_top"), *[c.alias(f"z{i}") for i, c in enumerate(z)], *[c.alias(f"p{i}") for i, c in enumerate(_softmax(z))])
        norm = F.log(sum((F.exp(F.col(f"z{i}") - F.col("_top")) for i in range(n)), F.lit(0.0))) + F.col("_top")
        own = sum((F.when(F.col("d") == i, F.col(f"z{i}")).otherwise(0.0) for i in range(n)), F.lit(0.0))
        p = [F.col(f"p{i}") for i in range(n)]
        r = rows.agg(
            F.sum(w * (norm - own)).alias("loss"),
            *[F.sum(w * by[k] * (p[k % n] - (F.col("d") == k % n).cast("int"))).alias(f"g{k}") for k in range(2 * n)],
            *[F.sum(w * by[j] * by[k] * p[j % n] * ((1 if j % n == k % n else 0) - p[k % n])).alias(f"h{j}_{k}") for j, k in pairs]).first()
        away = [u - v for u, v in zip(x, rest)]
        slope = [r[f"g{k}"] + strength * away[k] for k in range(2 * n)]
        bend = [[r[f"h{min(j, k)}_{max(j, k)}"] + (strength if j == k else 0.0) for k in range(2 * n)] for j in range(2 * n)]
        return r["loss"] + strength / 2 * sum(v * v for v in away), slope, bend

    at, step, best = [0.0] * (2 * n), [0.0] * (2 * n), math.inf
    for _ in range(rounds):
        tried = [x - y for x, y in zip(at, step)]
        loss, slope, bend = state(tried)
        if loss > best:
            step = [x / 2 for x in step]
            continue
        gain, at, best = best - loss, tried, loss
        if gain < 1e-6 * best:
            break
        step = _solve(bend, slope)
    # evidence for a domain never speaks against it; six places: the order of summation does not show
    return [round(max(x, 0.0), 6) for x in at[:n]], [round(x, 6) for x in at[n:]]


def calibrated(scored: DataFrame, held: DataFrame, domains: list[str], shares: list[float]) -> DataFrame:
    """``doc_id, _h, n_tokens, copies, p0, p1, ..``: the posterior of every document's own evidence.

    Naive Bayes takes words for independent and reads nothing from those that
    a text lacks, so its evidence is too sure; a temperature and a shift of
    each domain, fitted on labelled documents that it was not trained on, put
    that right.  A text without words keeps the domains' shares.
    """
    n = len(domains)
    known = held.groupBy(F.col("doc_id").alias("_id")).agg(F.min("domain").alias("domain"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED_ROWS)
    number = F.coalesce(*[F.when(F.col("domain") == d, F.lit(i)) for i, d in enumerate(domains)])
    rows = stored(scored.filter("n_tokens > 0").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
                  .select(number.alias("d"), "copies", *[f"s{i}" for i in range(n)]).repartition(4), "held_out")
    temper, shift = fit_scale(rows, shares)
    none = F.col("n_tokens") == 0
    plain = _softmax([F.lit(x) for x in shares])
    # eight places: the order of summation does not show
    return scored.select("doc_id", "_h", "n_tokens", "copies", *[
        F.round(F.when(none, q).otherwise(p), 8).alias(f"p{i}")
        for i, (p, q) in enumerate(zip(_softmax(_scaled(temper, shift, shares)), plain))])


def text_hash() -> Column:
    """What tells the texts of an id apart; a null text counts as empty."""
    return F.xxhash64(text_or_empty())


def evidence(docs: DataFrame, weights: DataFrame, n: int) -> DataFrame:
    """``doc_id, _h, n_tokens, copies, s0, s1, ..``, the sums of the words' weights, for each different (doc_id, text).

    ``_h`` is the text's hash; ``copies`` rows have id and text.
    """
    d = docs.select("doc_id", text_hash().alias("_h"), words(text_or_empty()).alias("_a"))
    d = d.select("doc_id", "_h", F.size("_a").alias("_n"), F.posexplode_outer(F.array_distinct("_a")).alias("_i", "_w"))
    d = d.select("doc_id", "_h", "_n", "_i", _feature(F.col("_w")).alias("f"))
    d = d.join(F.broadcast(weights), "f", "left")
    d = d.groupBy("doc_id", "_h", "_n").agg(F.sum(F.when(F.coalesce("_i", F.lit(0)) == 0, 1).otherwise(0)).alias("copies"),
                                            *[F.sum(f"w{i}").alias(f"s{i}") for i in range(n)])
    return d.select("doc_id", "_h", F.col("_n").cast("long").alias("n_tokens"), "copies",
                    *[F.coalesce(F.col(f"s{i}") / F.col("copies"), F.lit(0.0)).alias(f"s{i}") for i in range(n)])


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Gaussian elimination with pivots for a system of a few domains."""
    n = len(b)
    m = [row[:] + [x] for row, x in zip(a, b)]
    for i in range(n):
        k = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[k] = m[k], m[i]
        for r in range(n):
            if r != i and m[i][i]:
                q = m[r][i] / m[i][i]
                m[r] = [x - q * y for x, y in zip(m[r], m[i])]
    return [m[i][n] / m[i][i] if m[i][i] else 0.0 for i in range(n)]


def fit_rates(soft: DataFrame, targets: list[float], budget: float | None = None, rounds: int = ROUNDS,
              tolerance: float = 1e-5) -> Column:
    """The rate as an expression over ``p0, p1, ..``; ``budget`` in tokens, all tokens by default."""
    n = len(targets)
    mass = F.col("n_tokens") * F.col("copies")
    total = float(soft.agg(F.sum(mass)).first()[0] or 0)
    rate = F.lit(1.0)
    if not total:
        return rate
    want = [(budget if budget is not None else total) * t / sum(targets) for t in targets]
    for _ in range(rounds):
        # the metric is that of the documents still in: those out don't move against the step
        part = F.when(rate > 0, mass).otherwise(0)
        row = soft.agg(*[F.sum(rate * mass * F.col(f"p{i}")).alias(f"g{i}") for i in range(n)],
                       *[F.sum(part * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"h{i}_{j}") for i in range(n) for j in range(i, n)]).first()
        residual = [float(row[f"g{i}"] or 0) - w for i, w in enumerate(want)]
        if max(map(abs, residual)) <= tolerance * total:
            break
        # a little weight on the diagonal: a domain that hardly any document has
        h = [[float(row[f"h{min(i, j)}_{max(i, j)}"] or 0) + (1e-6 * total if i == j else 0) for j in range(n)] for i in range(n)]
        step = [float(f"{x:.9g}") for x in _solve(h, residual)]
        move = sum((F.col(f"p{i}") * x for i, x in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, budget_of: str | None = None,
          spare: float = 1.0) -> DataFrame:
    """``doc_id, _h, n_tokens, copies, p_<domain>.., rate`` for each different (doc_id, text) of ``docs``.

    The budget is all tokens or, with ``budget_of``, what leaves that domain
    ``spare`` times its expected tokens.
    """
    domains = sorted(targets)
    seen, held = held_out(labelled, domains)
    weights, shares = train(docs, seen, domains)
    soft = stored(calibrated(stored(evidence(docs, weights, len(domains)), "evidence"), held, domains, shares), "posteriors")
    budget = None
    if budget_of is not None:
        own = F.sum(F.col("n_tokens") * F.col("copies") * F.col(f"p{domains.index(budget_of)}"))
        budget = spare * float(soft.agg(own).first()[0] or 0) * sum(targets.values()) / targets[budget_of]
    rate = fit_rates(soft, [targets[d] for d in domains], budget)
    return soft.select("doc_id", "_h", "n_tokens", "copies", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)],
                       F.round(rate, 6).alias("rate"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, budget_of: str | None = None,
        spare: float = 1.0) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>.., rate`` for every row of ``docs``."""
    rows = mixed(docs, labelled, targets, budget_of, spare).withColumn("_c", F.explode(F.expr("sequence(1, cast(copies as int))")))
    return rows.select("doc_id", "n_tokens", *[f"p_{d}" for d in sorted(targets)], "rate")


def op1_mixing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return mix(docs, label_domains(labels))
