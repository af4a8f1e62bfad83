import random

import numpy as np
import pytest

from graphweave.llm import near_dedup, shingles

from .conftest import ODD


def brute(rows):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            w = (t or "").encode().lower().split()
            sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus():
    rnd = random.Random(11)
    rows = list(ODD)
    n = 10
    for group in range(6):
        base = [f"g{group}w{rnd.randrange(60)}" for _ in range(rnd.choice([4, 30, 120, 400]))]
        for copy in range(40):
            w = list(base)
            for _ in range(rnd.randrange(0, max(1, len(w) // 30))):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
            if copy % 5 == 0:
                w = [x.upper() for x in w]
            rows.append((n, rnd.choice([" ", "\n", "\t "]).join(w), "en", "s"))
            n += 1
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(n + i, shared + " " + " ".join(f"q{rnd.randrange(10**6)}" for _ in range(60)), "en", "s") for i in range(60)]
    return rows


def test_components_equal_brute_force(make_docs):
    rows = corpus()
    got = {}
    for r in near_dedup.near_duplicates(make_docs(rows)).collect():
        got[r["doc_id"]] = (r["n_shingles"], r["component_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert got == brute(rows)


def test_keep_one_and_empty(make_docs):
    df = make_docs(corpus())
    out = near_dedup.keep_one(df)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.select("doc_id").collect()]
    want = [i for i, (_, c) in brute(corpus()).items() if i == c]
    assert sorted(x for x in kept if x is not None) == sorted(want) and kept.count(None) == 1
    assert near_dedup.near_duplicates(make_docs([])).count() == 0


def test_one_id_with_different_texts(make_docs):
    """Each text of a repeated id keeps its own links; nothing is lost and the kept rows don't depend on chance."""
    a, b = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, a + " more", "en", "s"), (3, b + " more", "en", "s"), (4, a, "en", "s"),
            (4, a + " even more", "en", "s"), (5, "c d e f g h", "en", "s"), (5, "c d e f g h", "de", "s"), (5, "c d e f g h", "en", "s")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(make_docs(rows)).collect())
    assert got == [(1, 96, 1, True), (1, 96, 1, True), (2, 97, 1, False), (3, 97, 1, False), (4, 96, 1, False), (4, 98, 1, False),
                   (5, 2, 5, True), (5, 2, 5, True), (5, 2, 5, True)]
    for parts in (1, 3, 7):
        kept = sorted((r["doc_id"], r["text"], r["lang"]) for r in near_dedup.keep_one(make_docs(rows).repartition(parts)).collect())
        assert kept == [(1, a, "en"), (1, b, "en"), (5, "c d e f g h", "de")]


def test_components_of_the_driver_table(spark):
    """All documents at sf0.01 against all pairs, exactly."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == want


@pytest.mark.parametrize("j", [0.5, 0.85, 0.95])
def test_registers_estimate_and_merge(j):
    rng = np.random.default_rng(4)
    mul, add = shingles.seeds(130)
    equal = []
    for _ in range(40):
        u = rng.integers(0, 2 ** 63, 500).astype(np.uint64)
        k = int(500 * j)
        a, b = u[:k + (500 - k) // 2], np.concatenate([u[:k], u[k + (500 - k) // 2:]])
        ra, rb = shingles.registers(a, mul, add), shingles.registers(b, mul, add)
        assert (shingles.merge(ra, rb) == shingles.registers(np.union1d(a, b), mul, add)).all()
        equal.append((ra == rb).mean())
        one = lambda x: np.array([x], dtype=float)
        ok = shingles.plausible(ra[None], rb[None], one(len(a)), one(len(b)), 0.85, near_dedup.SLACK)[0]
        assert ok == (j >= 0.85)
    assert abs(np.mean(equal) - j) < 0.03


def test_shingle_sets_equal_definition():
    texts = ["", None, "a b", "A b c d e", "x " * 50, " lead\ttab\x0bvt\x0cff\rcr end ", "é É e", "a b c d e f"]
    for t, s in zip(texts, shingles.shingle_sets(texts), strict=True):
        w = (t or "").encode().lower().split()
        n = len({tuple(w[i:i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else int(bool(w))
        assert len(s) == n
