"""Operator 7: secret scans through a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived: the trigrams
that every match must contain, as ANDs and ORs.  Each batch of texts is an
index shard: one pass over its bytes (ASCII letters folded) posts the row
numbers of every trigram that some rule asks for, the postings are intersected
and united as the query says, and only the candidate texts are verified with
the regex, over their whole length.  A rule without mandatory trigrams (a run
of hex digits, say) scans every text.

Defined cases: a null text counts as empty and has no spans; repeated rows
keep their rows; an empty table gives an empty result; other columns are
ignored; matches of one kind never overlap, leftmost first; a private key runs
to its END line, or without one to the end of its block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Boolean trigram queries -------------------------------------------------
# A query is True (any text), a trigram (bytes), ("and", ...) or ("or", ...).

_SETS = 64  # alternatives followed exactly; beyond, a part says nothing


@dataclass(frozen=True)
class _Part:
    """What a regex part can match: exactly these strings, or only that ``query`` holds."""

    exact: frozenset[bytes] | None
    query: object = True


def _both(a: object, b: object) -> object:
    return b if a is True or a == b else a if b is True else ("and", a, b)


def _trigrams(strings: frozenset[bytes]) -> object:
    """A text holds one of ``strings`` only if this holds."""
    each = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in each:
        return True
    # a set of trigrams that contains another one asks for nothing more
    least = sorted(sorted(g) for g in each if not any(h < g for h in each))
    asks = [g[0] if len(g) == 1 else ("and", *g) for g in least]
    return asks[0] if len(asks) == 1 else ("or", *asks)


def _asks(p: _Part) -> object:
    return _both(p.query, _trigrams(p.exact)) if p.exact else p.query


def _sequence(items: list) -> _Part:
    query: object = True
    run: frozenset[bytes] | None = frozenset((b"",))
    whole = True
    for item in items:
        p = _part(item)
        if p.exact is not None and run is not None and len(run) * len(p.exact) <= _SETS:
            run = frozenset(a + b for a in run for b in p.exact)
            query = _both(query, p.query)
            continue
        if run is not None:
            query = _both(query, _trigrams(run))
        whole = False
        query = _both(query, p.query)
        run = p.exact if p.exact is not None and len(p.exact) <= _SETS else frozenset((b"",))
        if p.exact is None:
            run = frozenset((b"",))
    if whole:
        return _Part(run, query)
    return _Part(None, _both(query, _trigrams(run)))


def _part(item: tuple) -> _Part:
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return _Part(frozenset((chr(arg).encode().lower(),)))
    if op == "IN":
        chars: set[bytes] = set()
        for kind, what in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(what).encode().lower())
            elif str(kind) == "RANGE" and what[1] - what[0] < _SETS:
                chars.update(chr(c).encode().lower() for c in range(what[0], what[1] + 1))
            else:
                return _Part(None)
        return _Part(frozenset(chars)) if len(chars) <= 8 else _Part(None)
    if op == "SUBPATTERN":
        return _sequence(list(arg[3]))
    if op == "BRANCH":
        parts = [_sequence(list(b)) for b in arg[1]]
        if all(p.exact is not None and p.query is True for p in parts):
            return _Part(frozenset().union(*(p.exact for p in parts)))
        asks = [_asks(p) for p in parts]
        return _Part(None, True if any(a is True for a in asks) else ("or", *asks))
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, body = arg
        p = _sequence(list(body))
        if least == 0:
            return _Part(p.exact | {b""}) if most == 1 and p.exact is not None and p.query is True else _Part(None)
        if least == most and least <= 16:
            return _sequence(list(body) * least)
        if p.exact is not None and least <= 16:
            return _Part(None, _asks(_sequence(list(body) * least)))
        return _Part(None, _asks(p))
    if op in ("AT", "ASSERT_NOT", "ASSERT"):
        return _Part(frozenset((b"",)))
    return _Part(None)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query (of ASCII-folded UTF-8) that every text with a match satisfies."""
    return _asks(_sequence(list(re._parser.parse(pattern))))


def grams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(grams_of(q) for q in query[1:]))


class Shard:
    """Postings, for one batch of texts, of the trigrams in ``wanted``."""

    def __init__(self, texts: list[bytes], wanted: set[bytes], asked: np.ndarray):
        """``asked``: for each of the 2^24 trigrams, its number in sorted ``wanted`` from 1, or 0."""
        self.rows = np.arange(len(texts))
        self.postings = {g: np.empty(0, np.int64) for g in wanted}
        if not texts or not wanted:
            return
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 2)
        buf = np.frombuffer(b"\0\0".join(texts) + b"\0\0", np.uint8)
        names = sorted(wanted)
        for at in range(0, len(buf) - 2, 1 << 22):
            b = buf[at:at + (1 << 22) + 2].astype(np.uint32)
            which = asked[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
            hits = np.flatnonzero(which)
            if not len(hits):
                continue
            row = np.searchsorted(ends, hits + at, side="right")
            seen = np.unique(which[hits].astype(np.int64) * len(texts) + row)
            for g in np.unique(seen // len(texts)).tolist():
                own = seen[seen // len(texts) == g] % len(texts)
                self.postings[names[g - 1]] = np.union1d(self.postings[names[g - 1]], own)

    def candidates(self, query: object) -> np.ndarray:
        if query is True:
            return self.rows
        if isinstance(query, bytes):
            return self.postings[query]
        found = [self.candidates(q) for q in query[1:]]
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


# --- Rules -------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``pattern`` over the whole text; a match whose ``group`` has under ``least`` characters is dropped.

    ``search``, where given, finds exactly the same spans as pattern, group and
    least together, at less cost.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False
    search: str | None = None

    def spans(self, text: str) -> list[tuple[int, int]]:
        rx = re.compile(self.search or self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))
        return [m.span() for m in rx.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=8, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    # a maximal run: the shortest that counts can stand in the pattern
    Rule("hex", r"[0-9a-f]+", least=32, search=r"[0-9a-f]{32,}"),
)
# A key from its first line to the matching END line, whatever stands between (quote marks, numbers of lines), but
# not beyond another BEGIN or END line.  Without one, to the end of the key block: header lines, lines of base64 alone,
# runs of base64 in one line (the last may be short if padded) and an END line of another name.
_BREAK = r"(?:\s|\\[nrt])"
_KEY = (r"-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----(?:"
        r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END \1PRIVATE KEY-----"
        r"|(?:" + _BREAK + r"*+(?:(?:Proc-Type|DEK-Info|Comment|Version): [^\n\\]*+"
        r"|(?:[A-Za-z0-9+/]{16,}+={0,2}+|[A-Za-z0-9+/]++={1,2}+|(?<=\n)[A-Za-z0-9+/]++(?=[ \t\r]*+(?:\n|\Z))"
        r"|(?<=\\n)[A-Za-z0-9+/]++(?=\\|[\"'\s]|\Z))))*+"
        r"(?:" + _BREAK + r"*+-----END [A-Z ]{0,40}-----)?)")
ADDED = (
    Rule("private_key", _KEY),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_hook", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("live_key", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"://[^\s/:@]*:[^\s/:@]{3,}@"),
)
RULES = BASE + ADDED


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text, spans`` per row; spans are structs (kind, start, stop), in code points with the
    end exclusive, sorted by start, then by the order of ``rules``."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def output(b: pa.RecordBatch, found: list) -> pa.RecordBatch:
        rows = [[{"kind": rules[k].kind, "start": s, "stop": e} for s, k, e in f] for f in found]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, spans)], names=[*b.schema.names, "spans"])

    return _mapped(docs.select("doc_id", "text"), rules,
                   "doc_id long, text string, spans array<struct<kind:string,start:bigint,stop:bigint>>", output)


def _mapped(docs: DataFrame, rules: tuple[Rule, ...], schema, output) -> DataFrame:
    """``output(batch, spans per row as sorted (start, rule, stop))`` of every batch."""
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = set().union(*(grams_of(q) for q in queries)) if queries else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.zeros(1 << 24, np.uint8 if len(wanted) < 256 else np.uint16)
        for n, g in enumerate(sorted(wanted), 1):
            asked[int.from_bytes(g, "big")] = n
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            shard = Shard([t.encode("utf-8", "surrogatepass").lower() for t in texts], wanted, asked)
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k, (rule, query) in enumerate(zip(rules, queries)):
                for row in shard.candidates(query).tolist():
                    found[row] += [(s, k, e) for s, e in rule.spans(texts[row])]
            yield output(b, [sorted(f) for f in found])

    return docs.mapInArrow(run, schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of ``docs`` with every span replaced by ``<kind>``; overlapping spans share the first's mark."""

    def clean(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        out, at = [], 0
        for s, k, e in spans:
            if s >= at:
                out += [text[at:s], f"<{rules[k].kind}>"]
            at = max(at, e)
        return "".join(out) + text[at:] if spans else text

    def output(b: pa.RecordBatch, found: list) -> pa.RecordBatch:
        i = b.schema.get_field_index("text")
        texts = [clean(t, f) for t, f in zip(b.column(i).to_pylist(), found)]
        return b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))

    return _mapped(docs, rules, docs.schema, output)


def op7_secret_scans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    n_base = len(BASE)
    names = [r.kind for r in rules]
    say = lambda f: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in f)

    def output(b: pa.RecordBatch, found: list) -> pa.RecordBatch:
        base = [[x for x in f if x[1] < n_base] for f in found]
        return pa.RecordBatch.from_pydict({
            "doc_id": b.column("doc_id"),
            **{f"n_{names[k]}": pa.array([sum(x[1] == k for x in f) for f in base], pa.int64()) for k in range(n_base)},
            "base_sha256": pa.array([hashlib.sha256(say(f).encode()).hexdigest() for f in base], pa.string()),
            "spans": pa.array([say(f) for f in found], pa.string())})

    return _mapped(docs.select(F.col("doc_id").cast("long"), "text"), rules,
                   "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", output)
