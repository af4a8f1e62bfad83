"""Indel ratio, token-set and partial ratio against brute force (g9-g11)."""

import random

from graphweave.functions import fuzzy as fz


def dp_lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, c2 in enumerate(b):
            cur.append(prev[j] + 1 if ch == c2 else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def brute_partial(s1, s2):
    if len(s1) > len(s2):
        s1, s2 = s2, s1
    m, n = len(s1), len(s2)
    if m == 0 or n == 0:
        return 100.0 if m == n else 0.0
    return max(200.0 * dp_lcs(s1, s2[max(0, i):min(n, i + m)]) / (m + len(s2[max(0, i):min(n, i + m)]))
               for i in range(-(m - 1), n))


def rand_pairs(k, la, lb, seed=1):
    r = random.Random(seed)
    alpha = "abcd efg"
    return [("".join(r.choice(alpha) for _ in range(r.randint(0, la))),
             "".join(r.choice(alpha) for _ in range(r.randint(0, lb)))) for _ in range(k)]


def test_golden_ratios():
    assert fz.indel_ratio("abcd", "abxd") == 75.0                          # g10
    assert abs(fz.indel_ratio("abc", "axyc") - 400 / 7) < 1e-9             # g11
    a, b = "quantum computing", "computing quantum"
    ts = lambda s: " ".join(sorted(s.split()))
    assert fz.indel_ratio(ts(a), ts(b)) == 100.0                          # g9


def test_lcs_python_vs_dp():
    for a, b in rand_pairs(200, 80, 150):
        assert fz.lcs_len(a, b) == dp_lcs(a, b)


def test_lcs_spark_both_methods(spark):
    pairs = rand_pairs(150, 40, 90, seed=2) + [("", ""), ("a" * 70, "a" * 65)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for method in ("arrow", "sql"):
        for r in fz.with_lcs(df, "a", "b", "lcs", method=method).collect():
            assert r.lcs == dp_lcs(r.a, r.b), (method, r.a, r.b)


def test_token_set_spark_vs_python(spark):
    words = ["ai", "robot", "quantum", "grid", "Cloud", "cloud", "edge"]
    r = random.Random(3)
    pairs = [(" ".join(r.choice(words) for _ in range(r.randint(0, 5))),
              " ".join(r.choice(words) for _ in range(r.randint(0, 5)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in fz.with_token_set_ratio(df, "a", "b", "ts").collect():
        assert abs(row.ts - fz.token_set_ratio_py(row.a, row.b)) < 1e-9


def test_partial_ratio_vs_brute():
    r = random.Random(4)
    alpha = "abcde fg"
    for _ in range(150):
        a = "".join(r.choice(alpha) for _ in range(r.randint(1, 70)))
        b = "".join(r.choice(alpha) for _ in range(r.randint(1, 140)))
        if r.random() < 0.3:
            i = r.randint(0, len(b))
            b = b[:i] + a[: r.randint(0, len(a))] + b[i:]
        exp = brute_partial(a, b)
        assert abs(fz.partial_ratio(a, b) - exp) < 1e-9
        got = fz.partial_ratio(a, b, 85)
        assert abs(got - (exp if exp >= 85 else 0.0)) < 1e-9


def test_pieces_filter_is_lossless(spark):
    """A pair reaching partial ratio >= 85 always has a piece inside the text."""
    from pyspark.sql import functions as F
    r = random.Random(5)
    alpha = "abcdef "
    rows = []
    for _ in range(150):
        a = "".join(r.choice(alpha) for _ in range(r.randint(5, 40)))
        b = list("".join(r.choice(alpha) for _ in range(r.randint(0, 60))) + a)
        for _ in range(r.randint(0, 4)):
            b.insert(r.randint(0, len(b)), "z")
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string").withColumn("p", fz.pieces(F.col("a"), 0.85))
    for row in df.collect():
        if len(row.b) >= len(row.a) and fz.partial_ratio(row.a, row.b) >= 85:
            assert any(p in row.b for p in row.p)
