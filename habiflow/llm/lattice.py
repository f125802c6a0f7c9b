"""Operator 11: near-duplicate embeddings by lattice hashing.

Each table projects a unit vector at random to eight dimensions (or several
times eight) and decodes it to the nearest point of the E8 lattice: the nearer
of the two nearest points of D8 and D8 + 1/2.  A vector is posted under its own
cell and under the neighbouring cells that it lies nearest to, which are the
moves by one of E8's 240 shortest vectors with the smallest distance.  Two
vectors meet where the own cell of one is an own or a probed cell of the other,
and are linked if the cosine of the whole vectors in doubles is 0.9 or more.

A pair that meets in several cells counts in the first table, and there in the
cell that both own or else that of the smaller id; a task decides that from
the two vectors alone, by decoding them again.  So links are counted without a
table of pairs: a task returns a number of links for each vector and a spanning
forest, both bounded by the rows that it read.  Cells with more than ``ROWS``
rows are cut into blocks by hash, and all pairs of blocks are tasks of their
own.  Equal vectors are one entry with a count.

How many cells there are follows the number of vectors: a table takes as many
E8 points for a key as keep the strangers in a cell about as many at any size,
and there are then as many tables as keep the chance to find a pair at a cosine
of 0.9 above 0.95 (`plan`); pairs that are nearer are found more surely.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite
component links with nothing and keeps its row, its component being its own id;
vectors of different lengths never link; repeated rows are rows of their own
and link with each other; a null vec_id keeps its row but can't name a
component (null if nobody in it has an id) and is never kept; an empty table
gives an empty result; other columns, labels too, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habiflow.llm.common import stored
from habiflow.llm.components import components

SEED = 11
COSINE = 0.9
ROWS = 2000
# by E8 points in a key: scale of a cell, probed cells, chance that a pair at cosine 0.9 meets in a table, and two
# orthogonal vectors do (measured on random pairs)
PLANS = {1: (1.5, 3, 0.494, 0.0043), 2: (2.0, 4, 0.313, 0.00012), 3: (2.5, 6, 0.246, 0.000033), 4: (3.0, 8, 0.213, 0.000011)}

_POSTING = "t int, dim int, key long, own boolean, g long, c long, vec binary"


def d8(x: np.ndarray) -> np.ndarray:
    """The nearest points of D8, integers with an even sum: round, and if the sum is odd round the worst coordinate the other way."""
    f = np.rint(x)
    off = x - f
    worst = np.abs(off).argmax(1)
    odd = np.flatnonzero(f.sum(1).astype(np.int64) & 1)
    f[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    return f


def e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is D8 and D8 + 1/2."""
    a, b = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(maxsize=1)
def shortest() -> np.ndarray:
    """E8's 240 shortest vectors."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def plan(n: int) -> tuple[int, int]:
    """E8 points in a key and tables for ``n`` different vectors."""
    points = 1
    while points < max(PLANS) and n * PLANS[points][3] > 256:
        points += 1
    return points, math.ceil(math.log(0.04) / math.log(1 - PLANS[points][2]))


@lru_cache(maxsize=64)
def _table(dim: int, points: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Projection, shift, multipliers of a cell's hash, and the hash of each move to a neighbour."""
    rng = np.random.default_rng([SEED, dim, points, t])
    project = rng.normal(size=(dim, 8 * points)) / PLANS[points][0]
    shift = rng.uniform(0, 2, 8 * points)
    multiply = rng.integers(-(1 << 63), (1 << 63) - 1, 8 * points) | 1
    twice = np.rint(2 * shortest()).astype(np.int64)
    moves = np.concatenate([(twice * multiply[8 * p:8 * p + 8]).sum(1) for p in range(points)])
    return project, shift, multiply, moves


def cells(unit: np.ndarray, points: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the own cell of each row and of the cells that it probes.

    A cell's hash is linear modulo 2^64 in its coordinates.  ``einsum`` gives a
    row the same bits whatever rows stand beside it, unlike a matrix product.
    """
    project, shift, multiply, moves = _table(unit.shape[1], points, t)
    x = (np.einsum("nd,dk->nk", unit, project) + shift).reshape(-1, 8)
    cell = e8(x)
    own = (np.rint(2 * cell).astype(np.int64).reshape(len(unit), -1) * multiply).sum(1)
    # |rest - move|^2 is smallest where their product is largest, as the moves are equally long
    gain = ((x - cell) @ shortest().T).reshape(len(unit), -1)
    nearest = np.argsort(-gain, axis=1, kind="stable")[:, : PLANS[points][1]]
    return own, own[:, None] + moves[nearest]


def unit_rows(vecs: pa.BinaryArray, size: int) -> np.ndarray:
    """Unit vectors in doubles of rows that hold as many bytes each; ``size`` is a component's."""
    x = np.frombuffer(b"".join(vecs.to_pylist()), np.float32 if size == 4 else np.float64).reshape(len(vecs), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cleaned(vectors: DataFrame) -> DataFrame:
    """``vec_id, h, vec``: the components as bytes and their hash, both null where the vector can't link."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    as_float, to = ("array<float>", np.float32) if kind == "float" else ("array<double>", np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs, hashes = [], []
            for v in b.column("embedding"):
                raw = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(to) + to(0)  # no negative zero
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                vecs.append(raw)
                hashes.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(hashes, pa.binary()), pa.array(vecs, pa.binary())],
                                             names=["vec_id", "h", "vec"])

    return (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(as_float))
            .mapInArrow(run, "vec_id long, h binary, vec binary"))


def postings(entries: DataFrame, size: int, points: int, tables: int, whole: bool) -> DataFrame:
    """The rows of ``entries(g, c, vec)`` under their own and their probed cells; ``vec`` only if ``whole``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.array([len(v) // size for v in b.column("vec").to_pylist()], np.int64)
            for dim in np.unique(dims).tolist():
                rows = b.take(pa.array(np.flatnonzero(dims == dim)))
                unit = unit_rows(rows.column("vec"), size)
                for t in range(tables):
                    own, probed = cells(unit, points, t)
                    for k in range(probed.shape[1] + 1):
                        n = len(own)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, t), pa.int32()), pa.array(np.full(n, dim), pa.int32()),
                             pa.array(own if not k else probed[:, k - 1]), pa.array(np.full(n, not k)),
                             rows.column("g"), rows.column("c"), rows.column("vec") if whole else pa.nulls(n, pa.binary())],
                            names=["t", "dim", "key", "own", "g", "c", "vec"])

    return entries.select("g", "c", "vec").mapInArrow(run, _POSTING)


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Merges the labels of the pairs a[i]-b[i] in place; yields the labels that were joined."""
    while True:
        high, low = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        apart = high != low
        if not apart.any():
            return
        to = np.arange(len(label))
        np.minimum.at(to, high[apart], low[apart])
        for x in np.flatnonzero(to != np.arange(len(label))).tolist():
            yield x, int(to[x])
        while not np.array_equal(to, to[to]):
            to = to[to]
        label[:] = to[label]


def compare(rows: pa.Table, size: int, points: int, cosine: float) -> tuple[list[int], list[int | None], list[int]]:
    """Links of one cell or pair of blocks of a cell: ``(g, null, links)`` a vector and ``(g, g, 0)`` a tree edge."""
    own, block = rows.column("own").to_numpy(), rows.column("b").to_numpy()
    t, key, i, j = (rows.column(c)[0].as_py() for c in ("t", "key", "i", "j"))
    if len(own) < 2 or not own.any():
        return [], [], []
    g, c = rows.column("g").to_numpy(), rows.column("c").to_numpy()
    unit = unit_rows(rows.column("vec").combine_chunks(), size)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    links, label, edges = np.zeros(len(g), np.int64), np.arange(len(g)), []
    hashes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def in_table(k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in hashes:
            hashes[k] = cells(unit, points, k)
        return hashes[k]

    def meet(k: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mine, probed = in_table(k)
        return (mine[a] == mine[b], (probed[a] == mine[b][:, None]).any(1), (probed[b] == mine[a][:, None]).any(1))

    for at in range(0, len(left), 256):
        l = left[at:at + 256]  # noqa: E741
        near = (unit[l] @ unit[right].T >= cosine) & (own[l][:, None] | own[right][None, :])
        if i == j:
            near &= l[:, None] < right[None, :]
        a, b = np.nonzero(near)
        a, b = l[a], right[b]
        for k in range(t):  # pairs that an earlier table has counted
            if len(a):
                same, ab, ba = meet(k, a, b)
                first = ~(same | ab | ba)
                a, b = a[first], b[first]
        if not len(a):
            continue
        same, ab, ba = meet(t, a, b)
        home = in_table(t)[0][np.where(g[a] < g[b], a, b)]
        here = same | ~(ab & ba) | (home == key)
        a, b = a[here], b[here]
        np.add.at(links, a, c[b])
        np.add.at(links, b, c[a])
        edges += _joined(label, a, b)
    some = np.flatnonzero(links)
    return ([*g[some].tolist(), *(int(g[x]) for x, _ in edges)], [None] * len(some) + [int(g[y]) for _, y in edges],
            [*links[some].tolist(), *[0] * len(edges)])


def found_links(entries: DataFrame, size: int, points: int, tables: int, cosine: float = COSINE, rows: int = ROWS) -> DataFrame:
    """``u, v, n``: with a null v, n links of u counted in one place; else a tree edge."""
    cell = ["t", "dim", "key"]
    hot = stored(postings(entries, size, points, tables, False).groupBy(*cell).agg(F.count("*").alias("n")).filter(f"n > {rows}")
                 .select(*[F.col(k).alias(f"_{k}") for k in cell], F.ceil(F.col("n") / rows).cast("int").alias("blocks")), "hot_cells")
    on = [F.col(k) == F.col(f"_{k}") for k in cell]
    by = [*cell, "i", "j"]
    dealt = (postings(entries, size, points, tables, True).join(hot, on[0] & on[1] & on[2], "left")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("b", F.pmod(F.xxhash64("g", F.lit(7)), F.col("blocks")).cast("int"))
             # block b meets every block: as the left one those from b on, as the right one those before
             .withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select(*cell, F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "own", "g", "c", "vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table) -> list[int]:
            """Where groups begin."""
            new = np.zeros(len(table), bool)
            new[0] = True
            for k in by:
                x = table.column(k).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return [*np.flatnonzero(new).tolist(), len(table)]

        def out(parts: list[pa.Table]) -> pa.RecordBatch:
            u, v, n = [], [], []
            for p in parts:
                for to, more in zip((u, v, n), compare(p, size, points, cosine)):
                    to += more
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())],
                                              names=["u", "v", "n"])

        for b in batches:
            table = pa.Table.from_batches([b])
            table = table if held is None else pa.concat_tables([held, table])
            if not len(table):
                continue
            at = groups(table)
            yield out([table.slice(x, y - x) for x, y in zip(at[:-2], at[1:-1])])
            held = table.slice(at[-2])  # the last group may go on
        if held is not None and len(held):
            yield out([held])

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "u long, v long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, points: int | None = None, tables: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    size = 4 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else 8
    rows = stored(cleaned(vectors), "vectors")
    once = rows.filter("h is not null").groupBy("h").agg(F.count("*").alias("c"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"))
    entries = stored(once.withColumn("g", F.monotonically_increasing_id()), "entries")
    planned = plan(entries.count())
    found = stored(found_links(entries, size, points or planned[0], tables or planned[1], cosine), "links")
    counted = found.filter("v is null").groupBy(F.col("u").alias("g")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("v is not null").select("u", "v")).withColumnRenamed("node", "g")
    linked = stored(entries.select("g", "h", "c", "least").join(counted, "g", "left").join(roots, "g", "left")
                    .select("h", "least", (F.coalesce("n", F.lit(0)) + F.col("c") - 1).alias("n_links"),
                            F.coalesce("root", "g").alias("root")), "linked")
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(names, "root").select("h", "n_links", "component_id")
    return (rows.select("vec_id", "h").join(named, "h", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op11_embedding_near_dedup(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


# all pairs, so it is for small tables
OP11_SQL = """
WITH RECURSIVE r AS (
  SELECT row_number() OVER () AS i, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), x AS (
  SELECT i, unnest(e) AS c FROM r
), ok AS (
  SELECT i, sqrt(sum(c * c)) AS n FROM x GROUP BY i HAVING bool_and(c IS NOT NULL AND isfinite(c)) AND sum(c * c) > 0
), u AS (
  SELECT r.i, r.vec_id, r.e, ok.n FROM r JOIN ok USING (i)
), l AS (
  SELECT a.i AS a, b.i AS b FROM u a JOIN u b
  ON a.i <> b.i AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9
), reach(a, b) AS (
  SELECT i, i FROM r UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b
), named AS (
  SELECT reach.a AS i, min(r.vec_id) AS component_id FROM reach JOIN r ON r.i = reach.b GROUP BY reach.a
), counted AS (
  SELECT a AS i, count(*) AS n_links FROM l GROUP BY a
)
SELECT r.vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(r.vec_id = component_id, false) AS kept
FROM r JOIN named USING (i) LEFT JOIN counted USING (i)
"""
