"""Hard negatives against all pairs."""

import numpy as np
import pytest

from emberlog.llm import negatives
from emberlog.llm.neighbours import is_query

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string"


def plain(rows, every, k=5, m=3, kind=np.float32):
    if not rows:
        return []
    rows = [(i, np.floor(256 * np.array(v, kind).astype(float)).astype(np.int64), (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows]
    dim = max((len(v) for _, v, _ in rows), default=0) or 1
    v = np.array([np.r_[x, np.zeros(dim - len(x), np.int64)] for _, x, _ in rows]).reshape(len(rows), -1)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    out = []
    for a in np.flatnonzero(ids % every == 0):
        s = [int(x) for x in v @ v[a]]
        order = sorted((j for j in range(len(ids)) if j != a), key=lambda j: (-s[j], ids[j]))
        for p in [j for j in order if labels[j] == labels[a]][:k]:
            hard = [j for j in order if labels[j] != labels[a] and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:m]
            out += [(int(ids[a]), int(ids[p]), r + 1, int(ids[j]), int(s[p]), int(s[j])) for r, j in enumerate(hard)]
    return sorted(out)


def clustered(n, dim=12, spread=0.4, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = (centres[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)) * spread).astype(np.float32)
    x[30:60], x[70] = x[0], 0.0
    return [(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, rng.integers(0, 10, n), strict=True))]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 60, "ANCHORS": 9, "MEMBERS": 3, "STRIDE": 16}])
def test_hard_negatives_are_those_of_all_pairs(spark, monkeypatch, sizes):
    for name, n in sizes.items():
        monkeypatch.setattr(negatives, name, n)
    rows = clustered(900)
    odd = [(None, [1.0], 1), (9001, None, 1), (9002, [float("nan")], 1), (9003, [None, 1.0], 1), (9004, [float("inf")], 1), (9005, [1.0], None)]
    extra = [(9010, [], 3), (9020, [2.0, 1.0], 4), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + odd + extra], SCHEMA).repartition(3)
    want = plain(rows + extra[:2], 10)
    assert want and sorted(map(tuple, negatives.hard_negatives(df, every=10).collect())) == want


def test_large_components_few_rows_and_empty_tables(spark):
    rows = [(0, [3e6, -2e5], 1), (50, [2.5e6, 1.0], 2), (3, [1e6, 2e6], 2), (4, [2e6, 1e6], 3), (9, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain(rows, 50, kind=float)
    assert want and sorted(map(tuple, negatives.hard_negatives(df).collect())) == want
    for few in ([], [(1, [1.0], 1)], [(0, [1.0], 1)], [(0, [0.0], 1), (50, [0.0], 1), (2, [0.0], 2)]):
        got = negatives.hard_negatives(spark.createDataFrame(few, "vec_id long, embedding array<double>, label int"))
        assert sorted(map(tuple, got.collect())) == plain(few, 50)


def test_of_rows_with_one_id_the_least_counts(spark):
    rows = [(0, [1.0, 0.0], 2), (0, [9.0, 9.0], 1), (5, [2.0, 1.0], 1), (6, [1.0, 1.0], 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.hard_negatives(df).collect())) == plain([rows[1], *rows[2:]], 50)


def test_tight_clusters_end_the_walk_early():
    """Certified termination: members score a small part of the list and still find their best."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 32))
    data = centres[rng.integers(0, 20, 20_000)] + rng.normal(size=(20_000, 32)) * 0.05
    data = np.floor(256 * data / np.linalg.norm(data, axis=1, keepdims=True))
    centre = centres[3] / np.linalg.norm(centres[3])
    angles = negatives._angles(data, centre[None])[:, 0]
    members = np.argsort(angles)[:40]
    anchors = data[members]
    wanted = negatives._Wanted(5, np.full((40, 1), negatives._LEAST), np.full((40, 1), negatives._NEVER), True, members, np.zeros(40, int))
    ids, labels = np.arange(len(data)), np.zeros(len(data), int)
    walked = negatives.walk(anchors, angles[members], data, angles, ids, True, lambda: wanted.need(np.arange(40)), lambda a, c, s: wanted.take(a, ids[c], labels[c], s))
    assert walked.max() < 0.15 * len(data)
    slot, found, score = wanted.best.rows()
    for m in range(40):
        s = (data @ anchors[m]).astype(int)
        order = sorted((j for j in np.argsort(-s)[:200] if j != members[m]), key=lambda j: (-s[j], j))[:5]
        assert found[slot == m].tolist() == [int(j) for j in order]


def test_bounds_keep_far_rows_from_groups(spark, monkeypatch):
    """With several groups, rows go only where a member may need them."""
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "MEMBERS", 3)
    rng = np.random.default_rng(5)
    x = np.repeat(np.eye(8) * 9, 60, axis=0) + rng.normal(size=(480, 8)) * 0.05
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    clean = negatives._clean(df, 7, 10)
    lists = negatives.shared_lists(clean, is_query(10), 256)
    v = np.floor(256 * x.astype(np.float32).astype(float))
    far = lists.elsewhere(v, np.full(len(lists.centres), 0.5 * np.linalg.norm(v, axis=1).min()))
    assert len(lists.parts) > 4 and far.sum(axis=1).mean() < 0.5 * len(lists.parts)
    assert sorted(map(tuple, negatives.hard_negatives(df, every=10).collect())) == plain(rows, 10)
