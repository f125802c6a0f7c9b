"""Operator 2: quality rules as weak supervision.

Every rule votes good (1), bad (0) or abstains (null) from statistics of the
whole text.  Expectation-maximisation over the table of vote patterns (its
size is bounded by the rules, not by the corpus) estimates the share of good
documents and each rule's accuracy on good and on bad ones; a document's
posterior probability of being good replaces the rule that all must pass.
DataFrame functions only.

Defined cases: a null text has no words; a document without words fails the
base; repeated rows are judged alike, each keeps its own row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habiflow.llm.common import cut_lineage, stored, text_or_empty, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN 0 WHEN {self.good} THEN 1 END").cast("int").alias(self.name)


# Bounds differ by about a factor of five between the votes; what lies between abstains.
RULES = (
    Rule("v_length", "n_words < 40", "n_words >= 100"),
    Rule("v_sentences", "n_stops * 50 < n_words", "n_stops * 30 >= n_words"),
    Rule("v_symbols", "n_symbols * 10 > n_words", "n_symbols * 100 <= n_words"),
    Rule("v_symbol_share", "n_symbols * 50 > word_chars", "n_symbols * 500 <= word_chars"),
    Rule("v_word_length", "word_chars * 2 < 7 * n_words or word_chars * 2 > 13 * n_words", "word_chars >= 4 * n_words and word_chars <= 6 * n_words"),
    Rule("v_dup_lines", "n_dup_lines > 1 and n_dup_lines * 5 > n_lines", "n_lines >= 3 and n_dup_lines = 0"),
    Rule("v_repeats", "n_repeat_words * 10 > n_words", "n_repeat_words * 50 <= n_words"),
    Rule("v_stutter", "n_stutters * 20 > n_words", "n_stutters * 50 <= n_words"),
    Rule("v_capitals", "n_capitals * 10 > 3 * word_chars", "n_capitals * 20 <= 3 * word_chars"),
    Rule("v_shouts", "n_shouts * 10 > n_words", "n_shouts * 100 <= n_words"),
    Rule("v_digits", "n_digits * 5 > word_chars", "n_digits * 50 <= word_chars"),
)


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the counts that rules read, one row per input row.

    A window of eight words is repeated when its 64-bit hash occurs twice in
    the text.  Hashes are sorted packed with their position (one long each);
    those whose leading bits meet are compared by the full hash.  Linear in
    the text but for the sort, whatever the number of repeats.
    """
    d = docs.select(*keep, text_or_empty().alias("_t"))
    d = d.withColumn("_w", words(F.col("_t")))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    d = d.withColumn("_lines", F.expr(r"filter(split(_t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    d = d.withColumn("_h", F.expr(
        f"CASE WHEN n_words < {WINDOW} THEN cast(array() as array<bigint>) ELSE "
        f"transform(sequence(1, cast(n_words as int) - {WINDOW - 1}), i -> xxhash64(slice(_w, i, {WINDOW}))) END"))
    d = d.withColumn("_b", F.expr("length(bin(size(_h)))"))
    d = d.withColumn("_s", F.expr(
        "CASE WHEN size(array_distinct(_h)) = size(_h) THEN cast(array() as array<bigint>) ELSE "
        "sort_array(transform(_h, (h, i) -> shiftleft(h, _b) | cast(i as bigint))) END"))
    d = d.withColumn("_c", F.expr(
        "filter(_s, (x, j) -> shiftright(x, _b) <=> shiftright(get(_s, j - 1), _b) "
        "or shiftright(x, _b) <=> shiftright(get(_s, j + 1), _b))"))
    d = d.withColumn("_m", F.expr(
        "array_sort(transform(transform(_c, x -> cast(x & (shiftleft(1L, _b) - 1) as int)), "
        "p -> struct(_h[p] as h, p as p)))"))
    d = d.withColumn("_p", F.expr(
        "sort_array(transform(filter(_m, (x, j) -> x.h <=> get(_m, j - 1).h or x.h <=> get(_m, j + 1).h), x -> x.p))"))
    return d.select(
        *keep, "n_words",
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"aggregate(transform(_p, (p, j) -> least({WINDOW}, coalesce(get(_p, j + 1) - p, {WINDOW}))), "
               "0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.length(F.regexp_replace("_t", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("_t", r"[^!]+", "")).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace("_t", r"[^0-9]+", "")).cast("long").alias("n_digits"),
        F.length(F.regexp_replace("_t", r"[^.?]+", "")).cast("long").alias("n_stops"),
        F.expr("cast(size(filter(_w, (x, j) -> x <=> get(_w, j - 1))) as bigint)").alias("n_stutters"),
    )


def base_failed() -> Column:
    return ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and for each rule what it does on either class.

    ``on_good[j]`` and ``on_bad[j]`` are (P(votes bad), P(votes good)) of rule
    j there; it abstains otherwise.
    """

    prior: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]

    def accuracies(self) -> list[float]:
        """P(right | voted) of each rule."""
        q = self.prior
        return [(q * g[1] + (1 - q) * b[0]) / (q * sum(g) + (1 - q) * sum(b)) for g, b in zip(self.on_good, self.on_bad)]

    def posterior(self, rules: tuple[Rule, ...]) -> Column:
        z = F.lit(math.log(self.prior / (1 - self.prior)))
        for r, g, b in zip(rules, self.on_good, self.on_bad):
            z = z + (F.when(F.col(r.name) == 1, F.lit(math.log(g[1] / b[1])))
                     .when(F.col(r.name) == 0, F.lit(math.log(g[0] / b[0])))
                     .otherwise(F.lit(math.log((1 - sum(g)) / (1 - sum(b))))))
        return 1.0 / (1.0 + F.exp(-z))


# Where EM starts, and what its pseudo-documents vote: most documents are good, bad votes are rarer on them.
START = LabelModel(0.9, tuple((0.02, 0.8) for _ in RULES), tuple((0.3, 0.5) for _ in RULES))


def rates(bad: float, good: float) -> tuple[float, float]:
    """The two rates rounded, and away from 0 and from a sum of 1."""
    bad, good = max(bad, 1e-5), max(good, 1e-5)
    shrink = min(1.0, 0.9999 / (bad + good))
    return round(bad * shrink, 6), round(good * shrink, 6)


def fit_label_model(votes: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 50,
                    start: LabelModel | None = None, strength: float = 20.0) -> LabelModel:
    """EM over the counts of vote patterns of all rows of ``votes``.

    All rates are estimated: a rule that often votes bad beside nine good votes
    comes out as noisy, one that others agree with as sure.  ``strength``
    pseudo-documents of either class vote as ``start`` says, which keeps rules
    with few votes near it.  Which class is the good one is fixed by one bound:
    a rule votes bad no more often on good documents than on bad ones.
    Estimates are rounded to six places each round, so the order of summation
    does not show.
    """
    start = start or LabelModel(START.prior, START.on_good[:1] * len(rules), START.on_bad[:1] * len(rules))
    names = [r.name for r in rules]
    patterns = cut_lineage(votes.groupBy(*names).agg(F.count("*").alias("_n")).coalesce(1))
    m = start
    for _ in range(rounds):
        p = patterns.withColumn("_g", m.posterior(rules))
        good, bad = F.col("_n") * F.col("_g"), F.col("_n") * (1 - F.col("_g"))
        sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
        for j, v in enumerate(names):
            sums += [F.sum(F.when(F.col(v) == vote, weight)).alias(f"{of}{j}_{vote}")
                     for of, weight in (("good", good), ("bad", bad)) for vote in (0, 1)]
        s = {k: x or 0.0 for k, x in p.agg(*sums).first().asDict().items()}

        def share(of: str, j: int, vote: int, first: float) -> float:
            return (s[f"{of}{j}_{vote}"] + strength * first) / (s[of] + strength)

        on_good, on_bad = [], []
        for j in range(len(names)):
            g0, g1 = (share("good", j, k, start.on_good[j][k]) for k in (0, 1))
            b0, b1 = (share("bad", j, k, start.on_bad[j][k]) for k in (0, 1))
            on_good.append(rates(min(g0, b0), g1))
            on_bad.append(rates(b0, b1))
        n = s["good"] + s["bad"]
        new = LabelModel(round((s["good"] + strength * start.prior) / (n + strength), 6),
                         tuple(on_good), tuple(on_bad))
        if new == m:
            break
        m = new
    return m


def quality_rules(docs: DataFrame, *keep: str, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``keep`` columns, statistics, votes, ``base_failed``, ``quality`` (posterior) and ``kept``."""
    judged = stored(text_statistics(docs, *keep).select("*", *[r.vote() for r in rules]), "quality")
    # documents that fail the base are out whatever the votes; the model is for telling the others apart
    model = fit_label_model(judged.filter(~base_failed()), rules)
    return (judged.withColumn("base_failed", base_failed())
            .withColumn("quality", model.posterior(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def op2_quality_rules(docs: DataFrame) -> DataFrame:
    return quality_rules(docs, "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
