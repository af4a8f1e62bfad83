"""Exact and fuzzy dedupe (g7, g8) and the pair search against brute force."""

import itertools
import random

from graphweave.functions import fuzzy as fz
from graphweave.operators import dedupe as dd


def ts(s):
    return " ".join(sorted(s.split()))


def test_keep_first_g7(spark):
    from graphweave.functions.text import normalize_doi
    df = spark.createDataFrame([(1, "X"), (2, "x "), (3, "y")], "pos long, doi string")
    kept = dd.keep_first(df, normalize_doi("doi"), "pos")
    assert sorted(r.pos for r in kept.collect()) == [1, 3]


def _strings(seed=3, n=160):
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "zeta", "theta"]
    base = [" ".join(r.sample(words, r.randint(1, 3))) for _ in range(50)]

    def mut(s):
        s = list(s)
        for _ in range(r.randint(0, 3)):
            p = r.randrange(len(s) + 1)
            if r.random() < 0.5 and s:
                s.pop(min(p, len(s) - 1))
            else:
                s.insert(p, r.choice("abcxyz"))
        return "".join(s)
    return base + [mut(r.choice(base)) for _ in range(n - len(base))]


def test_similar_pairs_vs_brute(spark):
    strs = _strings()
    rows = list(enumerate(strs))
    df = spark.createDataFrame(rows, "id long, s string")
    for t in (75, 85, 90):
        got = {(r.id_a, r.id_b) for r in dd.similar_pairs(df, "id", "s", t).collect()}
        exp = set()
        for (i, a), (j, b) in itertools.combinations(rows, 2):
            A, B = ts(a), ts(b)
            if A and B and 200 * fz.lcs_len(A, B) >= t * (len(A) + len(B)):
                exp.add((min(i, j), max(i, j)))
        assert got == exp, t


def test_greedy_g8(spark):
    # a~b and b~c at 85, a!~c: keep a and c
    a, b, c = "abcdefghijklmnopqrst", "abcdefghijklmnopqrstuvw", "abcdefghijklmnopqrstuvwxyz12"
    assert fz.indel_ratio(a, b) >= 85 and fz.indel_ratio(b, c) >= 85 and fz.indel_ratio(a, c) < 85
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "id long, s string")
    kept = dd.greedy_fuzzy_dedupe(df, "id", "id", "s", 85)
    assert sorted(r.id for r in kept.collect()) == [1, 3]


def test_greedy_vs_sequential_scan(spark):
    strs = _strings(seed=7, n=120)
    rows = list(enumerate(strs))
    df = spark.createDataFrame(rows, "id long, s string")
    kept = {r.id for r in dd.greedy_fuzzy_dedupe(df, "id", "id", "s", 85).collect()}
    keep = []
    for i, s in rows:
        A = ts(s)
        if any(len(A) + len(ts(strs[j])) > 0 and 200 * fz.lcs_len(A, ts(strs[j])) >= 85 * (len(A) + len(ts(strs[j])))
               for j in keep):
            continue
        keep.append(i)
    assert kept == set(keep)
