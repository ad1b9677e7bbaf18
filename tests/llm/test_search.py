"""Both nearest-neighbour searches against brute force."""

import numpy as np
import pytest

from emberlog.llm import forest, neighbours, voronoi

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    x = (centres[rng.integers(0, 6, 1500)] + rng.normal(size=(1500, 12)) * 0.6).astype(np.float32)
    x[30:60] = x[0]  # ties
    rows = [(i, v.tolist(), 1, "x", "y") for i, v in enumerate(x)]
    odd = [(None, [1.0] * 12), (9001, None), (9002, [float("nan")] * 12), (9003, [None] + [1.0] * 11), (9004, [0.0] * 12), (9005, [float("inf")] + [0.0] * 11), (9006, []), (5, rows[5][1]), (7, rows[7][1])]
    return x, spark.createDataFrame(rows + [(i, v, 1, "x", "y") for i, v in odd], SCHEMA).repartition(3)


def brute(score, every, k, ids=None):
    ids = np.arange(len(score)) if ids is None else ids
    out = []
    for q in range(len(score)):
        if ids[q] % every == 0:
            order = sorted((i for i in range(len(score)) if i != q), key=lambda i: (-score[q, i], ids[i]))[:k]
            out += [(int(ids[q]), r + 1, int(ids[i]), score[q, i]) for r, i in enumerate(order)]
    return out


def test_forest_finds_neighbours(vectors):
    x, df = vectors
    d = x.astype(float)
    unit = d / np.linalg.norm(d, axis=1, keepdims=True)
    want = brute(unit @ unit.T, 10, 5)
    got = forest.nearest(df, every=10, k=5, trees=5, leaf=32, visits=60).collect()
    assert len(got) == len(want)
    exact = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    for (q, v), s in exact.items():
        assert s == pytest.approx(unit[q] @ unit[v], abs=1e-12)
    hits = sum((q, v) in exact or s <= min(z for (a, _), z in exact.items() if a == q) + 1e-12 for q, _, v, s in want)
    assert hits >= 0.9 * len(want)
    # equal vectors: the smaller ids first
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0] == [30, 31, 32, 33, 34]


def test_forest_small_blocks(vectors, monkeypatch):
    """Leaves in many cells give the same as leaves in one."""
    _, df = vectors
    key = lambda d: sorted(map(tuple, d.collect()))
    whole = key(forest.nearest(df, every=50, k=5, trees=3, leaf=64, visits=30))
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    assert key(forest.nearest(df, every=50, k=5, trees=3, leaf=64, visits=30)) == whole


@pytest.mark.parametrize("block", [4096, 50])
def test_voronoi_is_exact(vectors, monkeypatch, block):
    x, df = vectors
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERIES", block)
    v = np.floor(256 * x.astype(float)).astype(np.int64)
    v, ids = np.vstack([v, np.zeros((1, 12), np.int64)]), np.r_[np.arange(len(v)), 9004]
    want = brute(v @ v.T, 10, 5, ids)
    assert sorted(map(tuple, voronoi.largest_products(df, every=10, k=5).collect())) == sorted(want)


def test_voronoi_leaves_out_what_the_bounds_exclude(spark):
    """Far clusters: bounds spare most rows, and the result is still that of all pairs."""
    rng = np.random.default_rng(5)
    x = (np.repeat(np.eye(8) * 9, 60, axis=0) + rng.normal(size=(480, 8)) * 0.05).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    v = np.floor(256 * x.astype(float)).astype(np.int64)
    assert sorted(map(tuple, voronoi.largest_products(df, every=7, k=3).collect())) == sorted(brute(v @ v.T, 7, 3))


def test_large_components_and_few_rows(spark):
    big = [(0, [3e7, -2e6]), (50, [2.5e7, 1.0]), (3, [1e7, 2e7])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    v = np.floor(256 * np.array([b for _, b in big])).astype(np.int64)
    want = brute(v @ v.T, 50, 5, np.array([0, 50, 3]))
    assert sorted(map(tuple, voronoi.largest_products(df, every=50, k=5).collect())) == sorted(want)
    assert len(forest.nearest(df, every=50, k=5).collect()) == 4
    for rows in ([], [(1, [1.0, 2.0])], [(0, [1.0, 2.0])]):
        few = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert voronoi.largest_products(few).count() == forest.nearest(few).count() == 0
