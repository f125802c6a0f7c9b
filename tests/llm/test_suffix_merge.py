"""Merge of the shards' transforms: every repeated window found, and few symbols dealt for it."""

from collections import defaultdict

import numpy as np
import pytest

from habiflow.llm import suffix_dedup as S


def _brute(strings, span):
    at = defaultdict(list)
    for k, s in enumerate(strings):
        for o in range(len(s) - span + 1):
            at[s[o:o + span]].append((k, o))
    return sorted(sorted(x) for x in at.values() if len(x) > 1)


def _strings(rng, n, letters, planted):
    parts = [bytes(rng.integers(65, 65 + letters, rng.integers(0, 150)).astype(np.uint8)) for _ in range(n)]
    return [p[:20] + planted[rng.integers(0, 30):] + p[20:] if k % 3 else p for k, p in enumerate(parts)]


@pytest.mark.parametrize("span", [1, 3, 7, 8, 22, 100])
@pytest.mark.parametrize("letters", [1, 2, 26, 190])
def test_repeated_windows_are_those_of_brute_force(span, letters):
    rng = np.random.default_rng(span * 1000 + letters)
    planted = bytes(rng.integers(0, 256, 160).astype(np.uint8))
    strings = [*_strings(rng, 20, letters, planted), b"", planted, planted + planted, b"\x00\xff" * 120]
    owner, offset, block = S.repeated_windows(strings, span, shard_bytes=700)
    got = defaultdict(list)
    for k, o, b in zip(owner.tolist(), offset.tolist(), block.tolist()):
        got[b].append((k, o))
    assert sorted(sorted(x) for x in got.values()) == _brute(strings, span)


def test_what_is_settled_is_not_dealt_again(monkeypatch):
    rng = np.random.default_rng(7)
    planted = bytes(rng.integers(97, 123, 160).astype(np.uint8))
    strings = _strings(rng, 300, 26, planted)
    dealt, sort = [], np.argsort
    monkeypatch.setattr(S.np, "argsort", lambda a, *x, **kw: (dealt.append(len(a)), sort(a, *x, **kw))[1])
    assert S.later_windows(strings, np.arange(len(strings)))
    assert sum(dealt) < 40 * sum(map(len, strings))


@pytest.mark.parametrize("text", [b"a" * 400, b"ab" * 200, bytes(range(256)) * 2, b"x" * 99 + b"y"])
def test_an_anchor_that_stands_twice_is_told(text):
    h = S.gram_hashes(np.frombuffer(text, np.uint8), S.GRAM)
    for anchor, start, n, twice in zip(*S.segments(np.frombuffer(text, np.uint8))):
        assert twice == (np.count_nonzero(h[start:start + n + S.SPAN - S.GRAM] == anchor) > 1)
