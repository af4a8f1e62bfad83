"""Importance resampling against a plain Python version."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from graphweave.llm import importance

from .conftest import ODD, words

UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def feats(text, max_n=1):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=10, min_words=20, max_n=1, buckets=importance.BUCKETS, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in feats(text, max_n)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in feats(text, max_n)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        n_words, fs = feats(text, max_n)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((n_words, i, len(fs), weight, score))
    enough = sorted((r for r in rows if r[0] >= min_words), key=lambda r: (-r[4], r[1] is None, r[1], r[2]))
    k = percent * len(enough) // 100
    out = [(*r[1:], n if n <= k else None) for n, r in enumerate(enough, 1)] + [(*r[1:], None) for r in rows if r[0] < min_words]
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def rows():
    out = [(i, words(10 + i % 40, i % 7) + (" target word" * (i % 5)), "en", "s") for i in range(300)]
    return out + ODD + [(None, words(30, k), "en", "s") for k in range(3)] + [(7, words(40, 3), "en", "s")] * 4


@pytest.mark.parametrize("max_n,percent", [(1, 10), (2, 50), (1, 100), (1, 0)])
def test_equals_brute_force(spark, make_docs, rows, max_n, percent):
    target = ["Target word " * 30, None, "", words(50, 3)]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance.resample(make_docs(rows), bench, max_n=max_n, percent=percent)
    assert got(out) == brute([(r[0], r[1]) for r in rows], target, max_n=max_n, percent=percent)


def test_ties_at_the_cutoff(spark):
    """Rows of one score are cut at an id; rows equal in score and id are cut in number."""
    scores = spark.createDataFrame([(u, i, 30, 30, 0, 5) for u, i in enumerate([9, 4, 4, 4, 4, None, None, 1])]
                                   + [(90, 50, 30, 30, 0, 6), (91, 60, 30, 30, 0, 4)],
                                   "uid long, doc_id long, n_words long, n_features long, weight long, score long")
    for k in range(1, 11):
        out = importance.ranked(scores, k).select("doc_id", "score", "rank").collect()
        best = sorted((r for r in out if r["rank"] is not None), key=lambda r: r["rank"])
        order = [(50, 6), (1, 5), (4, 5), (4, 5), (4, 5), (4, 5), (9, 5), (None, 5), (None, 5), (60, 4)]
        assert [(r["doc_id"], r["score"]) for r in best] == order[:k]
        assert [r["rank"] for r in best] == list(range(1, k + 1)) and len(out) == 10


def test_empty_tables_and_carried_columns(spark, make_docs, rows):
    bench = spark.createDataFrame([], "text string")
    assert importance.resample(make_docs([], extra=False), bench).count() == 0
    out = importance.resample(make_docs(rows), bench, columns=["text", "rep"])
    drawn = out.where("rank is not null")
    assert drawn.count() > 0 and drawn.where(F.col("extra.text").isNull()).count() == 0
