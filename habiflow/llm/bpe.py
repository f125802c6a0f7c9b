"""Operator 9: BPE encoding and decoding, long texts by tree concatenation.

Texts are encoded as the tokenizers library encodes them with a public
vocabulary file.  A text of more than ``long_chars`` code points is cut into
halves, these into halves again, down to leaves that are encoded in parallel
as rows of their own.  Then pairs of neighbours are joined, level by level:
a window around the join is encoded anew and grows until, on either side,
``AGREE`` neighbouring tokens come out with the same ids at the same places as
on that side's own encoding.  From there on the side's tokens stand: in BPE a
row of tokens is the encoding of its text exactly if each neighbouring pair
is, so tokens that agree in a row carry the rest.  A window that reaches the
outer ends without agreement replaces the pair's whole encoding.

Shorter texts go through a table of the pieces between white space (white
space ends a token in these vocabularies), which is emptied when it is full.

Defined cases: a null text counts as empty, which has no tokens and decodes to
the empty text; repeated rows each keep their row (a long text is encoded once
for all its copies); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from string import ascii_letters, ascii_lowercase

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from habiflow.llm.common import text_or_empty

LONG_CHARS = LEAF_CHARS = 65_536
AGREE = 2
# str.split() parts at these too, the vocabularies' patterns may not
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_PLAIN_SPACE = re.compile("[ \t\n\r]+")


@lru_cache(maxsize=4)
def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, without truncation and padding; one thread, as Spark deals out the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class PieceEncoder(dict):
    """Encodes texts piece by piece and keeps the tokens of pieces seen, as bytes of ``dtype``.

    A new piece takes the library's own steps: normalize, pre-tokenize, model.
    Where a probe shows that the first two only fold the case of words of ASCII
    letters and part them from a mark that follows, such words go to the model
    at once and share their tokens.  Pieces with a special token in them take
    the library's encode.  The table has two generations of at most ``room``
    pieces: when the young one is full it becomes the old one, whose pieces
    move over as they recur.
    """

    def __init__(self, path: str, dtype: str = "<i4", room: int = 250_000):
        super().__init__()
        self.tokenizer, self.dtype, self.room = load_tokenizer(path), np.dtype(dtype), room
        self.old: dict[str, bytes] = {}
        t = self.tokenizer
        self.model, self.normalizer, self.splitter = t.model, t.normalizer, t.pre_tokenizer
        self.special = [str(x.content) for x in t.get_added_tokens_decoder().values()]
        parted = lambda text: [s for s, _ in self.splitter.pre_tokenize_str(text)]
        folds = self.normalizer.normalize_str(ascii_letters) == 2 * ascii_lowercase
        self.letters = folds and parted(ascii_lowercase) == [ascii_lowercase]
        self.marks = {m for m in ".,;:!?" if self.letters and self.normalizer.normalize_str(m) == m
                      and parted(ascii_lowercase + m) == [ascii_lowercase, m]}

    def ids(self, piece: str) -> list[int]:
        if any(s in piece for s in self.special):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        parts = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))
        return [t.id for s, _ in parts for t in self.model.tokenize(s)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def __missing__(self, piece: str) -> bytes:
        value = self.old.get(piece)
        if value is None:
            if not self.letters or not piece.isascii():
                value = self._bytes(self.ids(piece))
            elif piece.isalpha():
                small = piece.lower()
                value = self[small] if small != piece else self._bytes([t.id for t in self.model.tokenize(piece)])
            elif piece[-1] in self.marks and piece[:-1].isalpha():
                value = self[piece[:-1]] + self[piece[-1]]
            else:
                value = self._bytes(self.ids(piece))
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value

    def encode(self, text: str) -> np.ndarray:
        pieces = [p for p in _PLAIN_SPACE.split(text) if p] if _ODD_SPACE.search(text) else text.split()
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), self.dtype)


@lru_cache(maxsize=4)
def piece_encoder(path: str, dtype: str = "<i4", room: int = 250_000) -> PieceEncoder:
    """One table for all tasks of a worker."""
    return PieceEncoder(path, dtype, room)


# --- tree concatenation ------------------------------------------------------
# A node is (text, ids, ends): the tokens of the text taken by itself, and the
# code point where each ends.


def encode_node(tokenizer: Tokenizer, text: str) -> tuple[np.ndarray, np.ndarray]:
    e = tokenizer.encode(text, add_special_tokens=False)
    return np.array(e.ids, np.int32), np.array([b for _, b in e.offsets], np.int64)


def _runs(ids: np.ndarray, ends: np.ndarray) -> dict[tuple, int]:
    """Where each run of AGREE tokens (ids and ends) with plain, increasing ends starts."""
    rows = list(zip(ids.tolist(), ends.tolist()))
    return {tuple(rows[i:i + AGREE]): i for i in range(len(rows) - AGREE + 1)
            if all(rows[k][1] < rows[k + 1][1] for k in range(i, i + AGREE - 1))}


def join_nodes(tokenizer: Tokenizer, left: tuple, right: tuple, window: int = 64) -> tuple:
    """The node of both texts in a row, exact for any texts."""
    (lt, li, le), (rt, ri, re_) = left, right
    cut, text = len(lt), lt + rt
    if not lt or not rt:
        return right if not lt else left
    while True:
        a, b = max(0, cut - window), min(len(text), cut + window)
        wi, we = encode_node(tokenizer, text[a:b])
        we = we + a
        # tokens of the left that end inside the window, and of the right that do
        l0, r1 = int(np.searchsorted(le, a, "right")), int(np.searchsorted(re_, b - cut, "left"))
        start, stop, keep_left, keep_right = 0, len(wi), 0, len(ri)
        agreed_left, agreed_right = a == 0, b == len(text)
        inside = _runs(wi, we)
        if not agreed_left:
            for i in range(l0, len(li) - AGREE + 1):
                k = inside.get(tuple(zip(li[i:i + AGREE].tolist(), le[i:i + AGREE].tolist())))
                if k is not None:
                    keep_left, start, agreed_left = i + 1, k + 1, True
                    break
        if not agreed_right:
            ends = re_ + cut
            for i in range(r1 - AGREE, -1, -1):
                k = inside.get(tuple(zip(ri[i:i + AGREE].tolist(), ends[i:i + AGREE].tolist())))
                if k is not None and k >= start:
                    keep_right, stop, agreed_right = i + 1, k + 1, True
                    break
        if agreed_left and agreed_right:
            ids = np.concatenate((li[:keep_left], wi[start:stop], ri[keep_right:]))
            return text, ids, np.concatenate((le[:keep_left], we[start:stop], re_[keep_right:] + cut))
        window *= 4


def _levels(length: Column, leaf_chars: int) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2(length / F.lit(leaf_chars)))).cast("int")


def _packed(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """Ids and the distances between ends, compressed."""
    return zstandard.compress(ids.astype("<i4").tobytes() + np.diff(ends, prepend=0).astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.decompress(data), "<i4").reshape(2, -1)
    return both[0], np.cumsum(both[1], dtype=np.int64)


def encode_long(texts: DataFrame, path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``sha, tokens`` (packed), one row for each sha of ``texts(sha, text)``, by tree concatenation."""
    parts = texts.withColumn("levels", _levels(F.length("text"), leaf_chars))
    parts = parts.withColumn("node", F.explode(F.expr("sequence(0, cast(shiftleft(1, levels) as int) - 1)")))
    size = F.ceil(F.length("text") / F.expr("shiftleft(1, levels)")).cast("int")
    leaves = (parts.select("sha", "levels", "node", F.substring("text", F.col("node") * size + 1, size).alias("text"))
              .dropDuplicates(["sha", "node"]))

    schema = "sha string, levels int, node int, text string, tokens binary"

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(tokens=[_packed(*encode_node(load_tokenizer(path), t)) for t in b["text"]])

    def merged(level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def merge(group: pd.DataFrame) -> pd.DataFrame:
            if group["levels"].iloc[0] < level:
                return group
            group = group.sort_values("node")
            left, right = ((t, *_unpacked(p)) for t, p in zip(group["text"], group["tokens"]))
            text, ids, ends = join_nodes(load_tokenizer(path), left, right)
            return pd.DataFrame({"sha": group["sha"].iloc[:1].array, "levels": level - 1, "node": group["node"].iloc[0] // 2,
                                 "text": [text], "tokens": [_packed(ids, ends)]})

        return merge

    nodes = leaves.mapInPandas(encode, schema)
    for level in range(texts.agg(F.max(_levels(F.length("text"), leaf_chars))).first()[0] or 0, 0, -1):
        # nodes of smaller trees wait as groups of one
        pair = F.expr(f"CASE WHEN levels = {level} THEN node div 2 ELSE node END").alias("_n")
        nodes = nodes.groupBy("sha", pair).applyInPandas(merged(level), schema)
    return nodes.select("sha", "tokens")


_IDS = pa.list_(pa.int32())


def _columns(ids: list, tokenizer: Tokenizer | None) -> dict[str, pa.Array]:
    """The columns ``ids`` and, with a tokenizer, ``decoded``."""
    out = {"ids": pa.array(ids, _IDS)}
    if tokenizer is not None:
        out["decoded"] = pa.array([tokenizer.decode(i, skip_special_tokens=False) for i in ids], pa.string())
    return out


def encode(docs: DataFrame, path: str, decoded: bool = False, long_chars: int = LONG_CHARS,
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row of ``docs``; ``decoded`` adds the text the ids decode to."""
    d = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    schema = "ids array<int>" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids = [enc.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id")} | _columns(ids, enc.tokenizer if decoded else None))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sha, tokens in zip(b.column("sha"), b.column("tokens")):
                ids = [_unpacked(tokens.as_py())[0]]
                yield pa.RecordBatch.from_pydict({"sha": pa.array([sha.as_py()], pa.string())}
                                                 | _columns(ids, load_tokenizer(path) if decoded else None))

    short = d.filter(F.length("text") <= long_chars).mapInArrow(run, "doc_id long, " + schema)
    long_ = d.filter(F.length("text") > long_chars).select("doc_id", "text", F.sha2("text", 256).alias("sha"))
    whole = encode_long(long_.select("sha", "text"), path, leaf_chars).mapInArrow(finish, "sha string, " + schema)
    return short.union(long_.select("doc_id", "sha").join(whole, "sha").drop("sha"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of ``encoded`` and ``decoded``: the text of the ids, special tokens kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id")} | _columns(b.column("ids").to_pylist(), load_tokenizer(path)))

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def op9_bpe_encoding(docs: DataFrame, path: str) -> DataFrame:
    d = encode(docs, path, decoded=True)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))
