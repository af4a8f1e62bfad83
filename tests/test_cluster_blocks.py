"""Nearest neighbours over many blocks: copies, near copies, far and tiny vectors, vectors that take no part."""

import random

import numpy as np
import pandas as pd
import pytest

from graphweave.operators import cluster

from test_cluster import brute, run


def nearest(rows):
    """Plain form of ``_nearest`` on (id, vec) rows."""
    x = np.array([v for _, v in rows], dtype=np.float64)
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    out = {}
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows):
            if a != b:
                out[a] = min(out.get(a, (np.inf, 0)), (d[i, j], b))
    return {a: (b, dist) for a, (dist, b) in out.items()}


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1.0, 1000.0), (1e-7, 0.0), (1e6, 0.0)])
def test_block_pairs_equal_brute_force(scale, shift):
    r = random.Random(3)
    rows = [(i % 60, [shift + scale * r.choice([r.random(), 0.5, 0.5 + 1e-9 * r.random()]) for _ in range(3)]) for i in range(90)]
    frame = pd.DataFrame(rows, columns=["id", "vec"])
    frame["key"] = [tuple(v) for v in frame["vec"]]
    ids = {k: sorted(set(g["id"])) for k, g in frame.groupby("key")}
    cls = pd.DataFrame([(c, list(k), v[0], v[min(1, len(v) - 1)]) for c, (k, v) in enumerate(ids.items())], columns=["c", "vec", "lo", "lo2"])
    found = pd.concat([cluster._score(cls[cls.c % 3 == i], cls[cls.c % 2 == j]) for i in range(3) for j in range(2)])
    got = {}
    for c, nn, dist in found.itertuples(index=False):
        for i in ids[tuple(cls.vec[c])]:
            if i != nn:
                got[i] = min(got.get(i, (np.inf, 0)), (dist, nn))
    assert {i: (nn, dist) for i, (dist, nn) in got.items()} == nearest(rows)


def test_copies_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_SIZE", 16)
    r = random.Random(5)
    pts = [[r.uniform(0, 10), r.uniform(0, 10)] for _ in range(60)]
    pts = [[float(np.float32(x)) for x in p] for p in pts + [pts[0]] * 9 + [pts[7], pts[30]]]
    assert run(spark, pts) == brute(pts)


def test_vectors_without_a_place_are_noise(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, None), (4, [float("nan")]), (5, [9.0]), (6, [9.5])], "id long, v array<float>")
    assert {x.id: x.cluster_id for x in cluster.leaf_clusters(df, "id", "v").collect()} == {1: 1, 2: 1, 3: -1, 4: -1, 5: 5, 6: 5}


def test_each_scan_of_all_pairs_runs_once(spark, monkeypatch):
    scans = spark.sparkContext.accumulator(0)
    score = cluster._score

    def counted(left, right):
        scans.add(len(left) * len(right))
        return score(left, right)
    monkeypatch.setattr(cluster, "_score", counted)
    df = spark.createDataFrame([(i, [float(i * i % 97), float(i)]) for i in range(40)], "id long, v array<float>")
    cluster.leaf_clusters(df, "id", "v").collect()
    assert scans.value == 2 * 40 * 40
