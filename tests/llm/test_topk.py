import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphweave.llm import topk


def brute(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            if sum(x * x for x in q) <= 2 ** 62:
                ok[i] = min(ok.get(i, q), q)
    out = []
    for i, q in ok.items():
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in ok.items() if j != i and len(c) == len(q))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 7)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "Q_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "C_BLOCK", blocks[1])
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 8) for i in range(30)]  # ties
    rows += [(200, None), (201, []), (202, [1.0, None] * 4), (203, [float("nan")] * 8), (204, [float("inf")] * 8),
             (None, [1.0] * 8), (205, [1e30] * 8), (206, [1e6] * 8), (5, [0.1] * 8), (300, [1.0, 2.0]), (301, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "dim": F.lit(2)})
    out = topk.search(df, F.col("vec_id") % 10 == 0, 7)
    got = sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, 7, 10)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [-1.0]), (2, [0.5])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in topk.search(df, F.col("vec_id") == 0, 20).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 2048), (0, 2, 1, -4096)]
    assert topk.search(df.limit(0), F.col("vec_id") == 0, 20).count() == 0
