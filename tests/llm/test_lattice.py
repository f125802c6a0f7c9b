import numpy as np
import pytest
from pyspark.sql import types as T

from habiflow.llm import lattice

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("key", T.StringType()), T.StructField("g", T.IntegerType())])


def planted(n: int, dim: int, low: float, seed: int = 4) -> np.ndarray:
    """Rows in pairs, the second at a cosine from ``low`` to 1 to the first."""
    rng = np.random.default_rng(seed)
    u, z = rng.normal(size=(2, n, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    z -= (z * u).sum(1)[:, None] * u
    z /= np.linalg.norm(z, axis=1)[:, None]
    cos = rng.uniform(low, 1, n)[:, None]
    return np.concatenate([u, 3.0 * (cos * u + np.sqrt(1 - cos * cos) * z)])


def brute(vecs: list) -> tuple[list[int], list[int]]:
    """Links and component (smallest place) of each vector."""
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for v in vecs]
    near = [[bool(i != j and ok[i] and ok[j] and len(vecs[i]) == len(vecs[j])
                  and np.dot(vecs[i], vecs[j]) / np.linalg.norm(vecs[i]) / np.linalg.norm(vecs[j]) >= 0.9)
             for j in range(len(vecs))] for i in range(len(vecs))]
    comp = list(range(len(vecs)))
    for _ in vecs:
        comp = [min([comp[i], *(comp[j] for j in range(len(vecs)) if near[i][j])]) for i in range(len(vecs))]
    return [sum(r) for r in near], comp


def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 3
    c = lattice.e8(x)
    twice = np.rint(2 * c)
    assert np.array_equal(twice, 2 * c) and (np.rint(c.sum(1)) % 2 == 0).all()
    assert (np.ptp(twice % 2, axis=1) == 0).all()  # all whole or all halves
    m = lattice.shortest()
    assert len(m) == 240 and np.allclose((m * m).sum(1), 2)
    best = ((x[:, None] - (c[:, None] + m[None])) ** 2).sum(-1).min(1)
    assert (((x - c) ** 2).sum(1) <= best + 1e-9).all() and (((x - c) ** 2).sum(1) <= 1 + 1e-9).all()


@pytest.mark.parametrize("points", [1, 2])
def test_op11_recall_against_brute_force(spark, points):
    vecs = planted(300, 48, 0.9)
    df = spark.createDataFrame([(i, v.tolist(), "x", 1) for i, v in enumerate(vecs)], SCHEMA)
    want = sum(brute([v.tolist() for v in vecs])[0])
    tables = 5 if points == 1 else 10
    got = {r["vec_id"]: r for r in lattice.near_duplicates(df, points=points, tables=tables).collect()}
    assert len(got) == 600 and 0.95 * want <= sum(r["n_links"] for r in got.values()) <= want
    assert all(r["component_id"] == (i % 300 if r["n_links"] else i) for i, r in got.items())
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_op11_a_dense_cell_in_blocks_counts_each_link_once(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=24)
    vecs = [(centre + 0.05 * rng.normal(size=24)).tolist() for _ in range(150)] + [rng.normal(size=24).tolist() for _ in range(50)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    links, comp = brute(vecs)
    entries = lattice.stored(lattice.cleaned(df).selectExpr("vec_id as g", "1L as c", "vec"), "test")
    for rows in (20, 2000):
        found = lattice.found_links(entries, 8, 1, 5, rows=rows).collect()
        count = [0] * 200
        for r in found:
            if r["v"] is None:
                count[r["u"]] += r["n"]
        assert count == links
        assert sum(r["v"] is not None for r in found) < 150 * 5 * 40
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(df).collect()}
    assert got == {i: (links[i], comp[i]) for i in range(200)}


def test_op11_defined_cases(spark):
    a, b = [1.0, 0.0, 0.5], [0.0, 1.0, -2.0]
    rows = [(5, a), (3, a), (3, a), (None, [2.0, 0.0, 1.0]), (9, b), (10, [-0.0, 1.0, -2.0]), (1, None), (1, []), (2, [0.0, 0.0, 0.0]),
            (4, [1.0, None, 0.5]), (6, [1.0, float("nan"), 0.5]), (7, [float("inf"), 0.0, 0.0]), (8, [1.0, 0.0, 0.5, 0.0]),
            (None, None), (11, [1e300, 0.0, 5e299])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lattice.op11_embedding_near_dedup(df).collect()),
                 key=str)
    want = [(5, 4, 3, False), (3, 4, 3, True), (3, 4, 3, True), (None, 4, 3, False), (11, 4, 3, False), (9, 1, 9, True), (10, 1, 9, False),
            *[(i, 0, i, True) for i in (1, 1, 2, 4, 6, 7, 8)], (None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert lattice.op11_embedding_near_dedup(df.limit(0)).count() == 0
    floats = df.withColumn("embedding", df.embedding.cast("array<float>")).filter("vec_id in (3, 5)")
    assert {(r["vec_id"], r["n_links"]) for r in lattice.op11_embedding_near_dedup(floats).collect()} == {(3, 2), (5, 2)}
