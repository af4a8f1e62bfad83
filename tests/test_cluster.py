"""Leaf clustering golden cases (g28, g29) and a brute-force cross-check."""

import random

import numpy as np

from graphweave.operators import cluster


def run(spark, pts):
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "id long, v array<float>")
    return {r.id: r.cluster_id for r in cluster.leaf_clusters(df, "id", "v").collect()}


def brute(pts):
    """Naive form of the same rule on a full distance matrix."""
    x = np.array(pts, dtype=np.float64)
    n = len(x)
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    np.fill_diagonal(d, np.inf)
    nn = [min(range(n), key=lambda j: (d[i, j], j)) for i in range(n)]
    root = []
    for i in range(n):
        seen, p = set(), i
        while True:
            q = nn[p]
            if nn[q] == p:
                root.append(min(p, q))
                break
            p = q
    out = {}
    for i in range(n):
        other = [d[i2, j] for i2 in range(n) if root[i2] == root[i] for j in range(n) if root[j] != root[i]]
        m = min(other) if other else None
        out[i] = root[i] if m is not None and d[i, nn[i]] < m else -1
    # cluster id = smallest member id
    members = {}
    for i, r in out.items():
        if r != -1:
            members.setdefault(r, []).append(i)
    return {i: (min(members[r]) if r != -1 else -1) for i, r in out.items()}


def test_g28(spark):
    got = run(spark, [[0.0], [1.0], [10.0], [11.0], [30.0]])
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: -1}


def test_g29(spark):
    assert set(run(spark, [[0.0], [1.0], [1.5]]).values()) == {-1}


def test_random_vs_brute(spark):
    r = random.Random(11)
    for _ in range(3):
        pts = [[r.uniform(0, 10), r.uniform(0, 10)] for _ in range(r.randint(5, 30))]
        assert run(spark, pts) == brute(pts)
