"""Lattice hashing against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from ledgerflow.llm import embedding_dedup as ed


def _brute(ids, X, cosine=0.95):
    U = X / np.linalg.norm(X, axis=1, keepdims=True)
    near = U @ U.T >= cosine
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(near))):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(ids)):
        least[find(i)].append(ids[i])
    return near, {ids[i]: min(least[find(i)]) for i in range(len(ids))}


def _mates(rng, a, cos):
    g = rng.normal(size=a.shape)
    g -= (g * a).sum(1, keepdims=True) * a
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    return cos * a + np.sqrt(1 - cos ** 2) * g


def test_nearest_point_is_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    p = ed.nearest_e8(x)
    whole, half = np.rint(p) == p, np.rint(p - 0.5) == p - 0.5
    assert (whole.all(1) | half.all(1)).all() and (p.sum(1) % 2 == 0).all()
    own = ((x - p) ** 2).sum(1)
    around = ((x[:, None] - p[:, None] - ed.SHORTEST[None]) ** 2).sum(2).min(1)
    assert (own <= around + 1e-9).all() and own.max() <= 1 + 1e-9 and len(ed.SHORTEST) == 240


@pytest.mark.parametrize("cos, least", [(0.95, 0.99), (0.98, 0.999)])
@pytest.mark.parametrize("dims", [16, 64, 384])
def test_recall_at_the_threshold(cos, least, dims):
    rng = np.random.default_rng(dims)
    a = rng.normal(size=(4000, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = _mates(rng, a, cos)
    h = ed.hasher(dims, 0.95, ed.TABLES, ed.PROBES, ed.LATTICES)
    found = np.zeros(len(a), bool)
    for t in range(h.tables):
        (ha, pa), (hb, pb) = h.cells(a, t), h.cells(b, t)
        found |= (ha == hb) | (pa == hb[:, None]).any(1) | (pb == ha[:, None]).any(1)
    assert found.mean() >= least


def test_pairs_at_the_threshold_are_judged_alike():
    """Vectors within rounding of the cosine: whatever block a pair meets in, one answer."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=(60, 24))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    unit = ed._units([v.tobytes() for v in np.concatenate([a, _mates(rng, a, 0.95)])])
    held = ed._Held((0.95, ed.TABLES, ed.PROBES, ed.LATTICES))
    whole = set(zip(*(x.tolist() for x in held._links(unit, np.arange(120), np.arange(120)))))
    assert all((j, i) in whole for i, j in whole)
    for i in range(60):
        alone = held._links(unit[[i, i + 60]], np.array([0]), np.array([1]))
        assert (len(alone[0]) == 1) == ((i, i + 60) in whole)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    centre = rng.normal(size=32)
    crowd = centre + rng.normal(size=(60, 32)) * 0.12 * np.linalg.norm(centre) / np.sqrt(32)
    X = np.concatenate([base, _mates(rng, base[:50], 0.97) * 3, _mates(rng, base[:30], 0.9), base[:20], base[:5] * 2, crowd])
    X = X.astype(np.float32).astype(np.float64)
    return [int(i) for i in rng.permutation(len(X)) * 3 + 1], X


@pytest.mark.parametrize("block, lattices", [(16, 1), (16, 2), (2048, 1), (2048, 2)])
def test_against_brute_force(spark, data, block, lattices):
    ids, X = data
    near, component = _brute(ids, X)
    rows = [(i, [float(x) for x in v], 1, "a") for i, v in zip(ids, X)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int, class string").repartition(3)
    got = {r["vec_id"]: r for r in ed.near_groups(frame, block=block, lattices=lattices).collect()}
    assert len(got) == len(ids)
    want = near.sum(1)
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= want).all()  # none below the threshold, no link counted twice
    assert found.sum() >= 0.99 * want.sum()
    right = [got[i]["component_id"] == component[i] for i in ids]
    assert np.mean(right) >= 0.99
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_awkward_rows(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(i + 10, v) for i, v in enumerate(bad)] + [(i + 30, v) for i, v in enumerate(bad)]
    rows += [(1, [1.0, 0.0]), (2, [2.0, 0.001]), (3, [1.0, 0.0, 0.0]), (4, [-1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ed.near_groups(frame).collect()
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in out)
    want = [(i, 0, i, True) for i in (*range(10, 16), *range(30, 36), 3, 4)]
    want += [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (-1, 3, 1, False), (-1, 0, -1, True)]
    assert got == sorted(want)
    assert ed.near_groups(frame.limit(0)).count() == 0
