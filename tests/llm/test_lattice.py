import itertools

import numpy as np
import pytest

from quirework.llm import lattice
from quirework.llm.queries import op4_lattice_cells


def plain(rows, cosine=0.95):
    """rows: (id, vector or None) -> sorted (id, links, component, kept)."""
    units = [None if (u := lattice.unit(v)) is None else np.frombuffer(u) for _, v in rows]
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]):
            if float(units[i] @ units[j]) >= cosine:
                n[i], n[j] = n[i] + 1, n[j] + 1
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return sorted((i, n[k], c := rows[find(k)][0], i == c) for k, (i, _) in enumerate(rows))


def test_query_equals_brute_force(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op4_lattice_cells(spark, small).collect())
    assert got == plain(rows)


def test_odd_vectors_and_chains(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=16)
    base /= np.linalg.norm(base)
    side = draw.normal(size=16)
    side -= side @ base * base
    side /= np.linalg.norm(side)
    turned = [[float(x) for x in np.cos(a) * base + np.sin(a) * side] for a in (0, 0.25, 0.5, 0.75)]
    rows = list(enumerate(turned, 10))
    rows += [(3, turned[3]), (20, [2 * x for x in turned[0]]), (21, [-x for x in turned[0]])]
    rows += [(30, None), (31, [0.0] * 16), (32, [float("nan")] * 16), (33, [float("inf")] + [1.0] * 15), (34, []), (35, [None] + [1.0] * 15)]
    rows += [(40, [1.0, 0.0]), (41, [1.0, 0.1]), (42, [1e300, 1e299]), (10, turned[0]), (50, [1e-300, 1e-301])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, unit int, digest string")
    got = sorted((r.id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(frame).collect())
    assert got == plain(rows)
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def test_missing_ids(spark):
    frame = spark.createDataFrame([(None, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [1.0, -2.0])], "vec_id long, embedding array<float>")
    got = sorted(map(str, (tuple(r) for r in lattice.near_duplicates(frame).collect())))
    assert got == sorted(["(None, 1, 5, False)", "(5, 1, 5, True)", "(None, 0, None, True)"])


def test_decoding_is_nearest():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(300, 8)) * 2
    found = lattice.e8_point(x) / 2
    sums = found.sum(axis=1)
    assert (sums % 2 == 0).all()
    assert ((found * 2 % 2 == 0).all(axis=1) | (found * 2 % 2 == 1).all(axis=1)).all()
    assert len(lattice.NEIGHBOURS) == 240 and len(np.unique(lattice.NEIGHBOURS, axis=0)) == 240
    around = found[:, None, :] + lattice.NEIGHBOURS[None] / 2
    assert (((x[:, None] - around) ** 2).sum(-1).min(1) >= ((x - found) ** 2).sum(-1) - 1e-9).all()


@pytest.mark.parametrize(("cosine", "least"), [(0.951, 0.97), (0.97, 0.998)])
def test_recall(spark, cosine, least):
    draw = np.random.default_rng(7)
    u = draw.normal(size=(1500, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = draw.normal(size=u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = cosine * u + np.sqrt(1 - cosine**2) * w
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate((u, v)))]
    found = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.where("n_links = 1 and component_id = vec_id % 1500".replace("vec_id", "id")).count() >= least * 3000


@pytest.mark.parametrize("vectors", [300_000, 10**9])
def test_recall_of_the_schemes_for_larger_tables(spark, vectors):
    """Pairs at cosine 0.95 are found as in small tables, and far fewer unrelated ones meet."""
    draw = np.random.default_rng(9)
    u = draw.normal(size=(1500, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = draw.normal(size=u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.951 * u + np.sqrt(1 - 0.951**2) * w
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate((u, v)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = lattice.near_duplicates(frame, **lattice.scheme(vectors))
    assert found.where("n_links = 1 and component_id = id % 1500").count() >= 0.97 * 3000
    unrelated = {}
    for n in (1000, vectors):
        met, tables = 0, lattice.Tables(64, seed=1, **(lattice.scheme(n) | {"tables": 4}))
        for own, probes in tables.cells(u):
            met += np.isin(probes, own).sum()
        unrelated[n] = met
    assert unrelated[vectors] * 50 < unrelated[1000]


def test_probes_are_the_nearest_cells():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(50, 16))
    tables = lattice.Tables(16, tables=1, scale=1.0, neighbours=20, seed=1, blocks=2)
    y = x @ tables.directions[0] + tables.shifts[0]
    cost, points = np.zeros((50, 1)), np.zeros((50, 1, 0), np.int64)
    for at in (0, 8):
        cost, points = tables.joined(cost, points, *tables.near(y[:, at : at + 8]))
    own = np.concatenate((lattice.e8_point(y[:, :8]), lattice.e8_point(y[:, 8:])), axis=1)
    assert (points[:, 0] == own).all() and points.shape == (50, 21, 16)
    farther = ((y[:, None] - points / 2) ** 2).sum(axis=2) - ((y - own / 2) ** 2).sum(axis=1)[:, None]
    assert np.allclose(farther, cost)


def test_the_largest_id_is_an_id(spark):
    top = 2**63 - 1
    frame = spark.createDataFrame([(top, [1.0, 2.0]), (None, [1.0, 2.0]), (top, [-1.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted(str(tuple(r)) for r in lattice.near_duplicates(frame).collect())
    assert got == sorted([f"({top}, 1, {top}, True)", f"(None, 1, {top}, False)", f"({top}, 0, {top}, True)"])


def test_equal_numbers_of_different_digests_are_set_apart(spark):
    from quirework.llm.shared import apart

    rows = [(7, b"a", 1), (7, b"b", 2), (8, b"c", 3), (7, b"d", 4)]
    got = apart(spark.createDataFrame(rows, "node long, digest binary, n int"), "node", "digest").collect()
    assert len({r.node for r in got}) == 4 and {r.n: r.node for r in got}[3] == 8
    with pytest.raises(ValueError, match="same number"):
        apart(spark.createDataFrame(rows[:1] * 2, "node long, digest binary, n int"), "node", "digest")
