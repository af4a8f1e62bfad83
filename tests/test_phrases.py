"""Phrase and partial-ratio matching of whole texts, and the two-table string join, against brute force."""

import random

import pytest

from graphweave.functions import fuzzy as fz
from graphweave.operators import dedupe, phrases

from test_fuzzy import brute_partial, dp_lcs


def spoiled(rnd, s, n):
    """``s`` with ``n`` characters changed, put in or left out."""
    out = list(s)
    for _ in range(n):
        i = rnd.randrange(len(out))
        out[i:i + 1] = rnd.choice([[], [rnd.choice("abcdefgh ")], [out[i], "x"]])
        out = out or ["a"]
    return "".join(out)


@pytest.mark.parametrize("cutoff", [60, 70, 85, 95])
def test_partial_scan_equals_brute_force(cutoff):
    rnd = random.Random(cutoff)
    words = ["solar", "panel", "ion", "é日本", "cell", "graph", "x", "of", "the"]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    needles = [say(rnd.randint(1, 9)) for _ in range(12)] + ["a", "ab", "abc", "aaaa"]
    hits = 0
    for _ in range(40):
        p = rnd.choice(needles)
        near = spoiled(rnd, p, rnd.randint(0, 1 + len(p) // 6))
        text = rnd.choice([near, say(rnd.randint(0, 3)) + near + say(rnd.randint(0, 4)), near[rnd.randint(0, 3):] + say(2), say(2) + near[:-2], ""])
        want = {k: s for k, q in enumerate(needles) if q not in text and (s := brute_partial(q, text)) >= cutoff}
        got = {k: x for _, k, x in fz.PartialScan(needles, cutoff).score([text])}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want), (text, got, want)
        hits += len(want)
    assert hits > 0


def test_partial_scan_on_long_passages():
    """Passages of several hundred characters inside texts of the same words."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("aeioustrnl") for _ in range(rnd.randint(2, 7))) for _ in range(60)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [say(rnd.randint(40, 70)) for _ in range(6)]
    scan = fz.PartialScan(passages, 85)
    for share in (0.02, 0.1, 0.14, 0.2, 0.4):
        for k, p in enumerate(passages):
            text = say(80) + " " + spoiled(rnd, p, int(share * len(p))) + " " + say(80)
            got = {k: x for _, k, x in scan.score([text])}
            for j, q in enumerate(passages):
                exact = fz.partial_ratio(q, text, 85.0) if q not in text else 0.0
                assert abs(got.get(j, 0.0) - exact) < 1e-9
            assert share > 0.02 or k in got or p in text


def test_near_ends_equal_the_distance_table():
    """Least Indel distance of a needle and a part that ends at each place, row by row; and the lanes of ``near_pairs``."""
    rnd = random.Random(8)
    needles, hays, least = [], [], []
    for _ in range(150):
        a = "".join(rnd.choice("abcé") for _ in range(rnd.choice([1, 2, 5, 63, 64, 65, 70, 130])))
        b = "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 60))) + spoiled(rnd, a, rnd.randint(0, 9)) * rnd.randint(0, 2)
        row = list(range(len(a) + 1))
        ends = [len(a)]
        for y in b:
            new = [0]
            for i, x in enumerate(a, start=1):
                new.append(min(row[i], new[i - 1]) + 1 if x != y else row[i - 1])
            row = new
            ends.append(row[-1])
        for limit in (0, len(a) // 4, len(a) - 1):
            assert fz.near_ends(a, b, limit) == [j for j, d in enumerate(ends) if j and d <= limit]
        needles.append(a)
        hays.append(b)
        least.append(min(ends))
    import numpy as np
    for rate in (0.1, 0.3, 0.5):
        pairs = np.array([(i, i) for i in range(len(needles))])
        near = fz.near_pairs(needles, hays, pairs, rate)
        for a, d, found in zip(needles, least, near, strict=True):
            assert found or d > rate * len(a)                # no near pair is lost
            if len(a) <= 64:
                assert found == (d <= int(rate * len(a) + 1e-9))


def test_shared_trigrams_is_a_lower_bound():
    rnd = random.Random(3)
    for _ in range(2000):
        p = "".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 30)))
        w = spoiled(rnd, p, rnd.randint(0, 6))[:len(p)]
        ratio = 200 * dp_lcs(p, w) / (len(p) + len(w)) if w else 0
        grams = {p[i:i + 3] for i in range(len(p) - 2)}
        shared = sum(w[i:i + 3] in grams for i in range(len(w) - 2))
        for cutoff in (60, 75, 85, 95):
            if ratio >= cutoff and (len(w) == len(p) or len(w) < len(p)):
                assert shared >= fz.shared_trigrams(len(p), cutoff), (p, w, ratio)


@pytest.mark.parametrize("block", [1000, 0])
def test_first_matches_give_the_least_place(spark, monkeypatch, block):
    monkeypatch.setattr(phrases, "AUTOMATON_MAX_ROWS", block)
    rnd = random.Random(6)
    words = ["solar", "panel", "batter", "cell", "日本", "x", "lar p"]
    texts = [(i if i else None, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9)))) for i in range(50)] + [(77, None), (78, "")]
    names = [(7 * k, s) for k, s in enumerate(rnd.sample([*words, "x x", "solar solar", "solar", "none", "", None], 12))]
    e, p = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(names[::-1], "place long, s string")
    rows = phrases.first_matches(e, "id", "t", p, "place", "s").collect()
    got = {i: min(r[1] for r in rows if r[0] == i) for i in {r[0] for r in rows}}
    want = {i: min(k for k, s in names if s and s in t) for i, t in texts if t and any(s and s in t for _, s in names)}
    assert got == want and (block == 0 or len(rows) == len(got))
    assert phrases.first_matches(e, "id", "t", p.limit(0), "place", "s").count() == 0


@pytest.mark.parametrize("block", [1000, 0])
def test_phrases_with_repeats_nulls_and_odd_ids(spark, monkeypatch, block):
    monkeypatch.setattr(phrases, "BLOCK_MAX_ROWS", block)
    texts = [("a", "one two three"), ("a", "two"), ("b", None), ("c", ""), ("d", "日本 two\none")]
    names = [(1, "two"), (2, "two"), (3, "one"), (4, ""), (5, None), (6, "e t"), (7, "\n")]
    e, p = spark.createDataFrame(texts, "id string, t string"), spark.createDataFrame(names, "pid int, s string")
    got = sorted(map(tuple, phrases.phrase_matches(e, "id", "t", p, "pid", "s").collect()))
    assert got == sorted((i, j) for i, t in texts for j, s in names if t is not None and s and s in t)
    assert phrases.phrase_matches(e.limit(0), "id", "t", p, "pid", "s").count() == 0
    assert phrases.phrase_matches(e, "id", "t", p.limit(0), "pid", "s").count() == 0


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("t", [55, 70, 90])
def test_similar_between_equals_brute_force(spark, monkeypatch, small, t):
    monkeypatch.setattr(dedupe, "fits_broadcast", lambda df: small)
    rnd = random.Random(t)
    words = ["alpha", "beta", "gam", "delta", "om", "s", "zeta"]
    left = [" ".join(rnd.sample(words, rnd.randint(1, 5))) for _ in range(60)] + ["", "a", None, "é"]
    right = [spoiled(rnd, s, rnd.randint(0, 4)) for s in left[:30] if s] + ["", "ab", None, "é", "x" * 500]
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "s string").repartition(3)
    got = {(r["sa"], r["sb"]): r["ratio"] for r in dedupe.similar_between(df(left), "s", df(right), "s", t).collect()}
    want = {(a, b): fz.indel_ratio(a, b) for a in left for b in right if a is not None and b is not None
            and 200 * fz.lcs_len(a, b) >= t * (len(a) + len(b))}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("groups", [1, 2, 3])
@pytest.mark.parametrize("cutoff", [70, 85])
def test_sieve_keeps_every_near_pair(monkeypatch, groups, cutoff):
    """Passages damaged up to the cutoff, anywhere in texts of several spans, pass; most other pairs don't."""
    rnd = random.Random(groups * cutoff)
    words = ["".join(rnd.choice("aeioustrnlmpdcgb") for _ in range(rnd.randint(3, 9))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [say(rnd.randint(3, 45)) for _ in range(9)] + [""]
    monkeypatch.setattr(fz.PieceSieve, "GROUPS", groups)
    monkeypatch.setattr(fz.PieceSieve, "SPAN", 300)
    monkeypatch.setattr(fz.PieceSieve, "PIECES", 16)
    texts = ["", "a", "日本"]
    for p in passages[:-1]:
        near = spoiled(rnd, p, int(rnd.choice([0.02, 0.1, 0.15, 0.25]) * len(p)))
        texts.append(rnd.choice([say(50) + " " + near + say(20), near + say(60), say(61) + near]))
    near = fz.PieceSieve(passages, 2 * (1 - cutoff / 100)).near(texts)
    want = {(i, k) for i, t in enumerate(texts) for k, p in enumerate(passages)
            if p and len(t) >= len(p) and fz.partial_ratio(p, t, cutoff) >= cutoff}
    assert want and want <= near
    long = [k for k, p in enumerate(passages) if len(p) > 150]
    if cutoff == 85:
        assert sum(k in long for _, k in near) < len(long) * len(texts) / 4
    got = {(i, k) for i, k, _ in fz.PartialScan(passages[:-1], cutoff).score(texts)}
    assert {x for x in want if passages[x[1]] not in texts[x[0]]} == {x for x in got if len(texts[x[0]]) >= len(passages[x[1]])}
