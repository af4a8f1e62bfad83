"""The pipeline against a brute-force version in plain Python."""

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from graphweave.llm import bpe, quality

from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute as brute_components
from .test_quality import numbers

RULES = ["symbols", "dup_lines", "length", "bangs", "stutter"]


def rule_values(text):
    n_words, chars, symbols, dup, _ = numbers(text)
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    n, m = max(n_words, 1), max(len(lines), 1)
    return [1000 * symbols // n, 1000 * dup // m, 100 * chars // n, 1000 * (text or "").count("!") // n,
            1000 * sum(a == b for a, b in zip(w, w[1:], strict=False)) // n]


def bucket(v):
    return v if v < 64 else v >> (v.bit_length() - 6) << (v.bit_length() - 6)


def quartiles(values):
    s = sorted(map(bucket, values))
    return len(s), [s[-(-q * len(s) // 100) - 1] for q in (25, 50, 75)]


def brute_quality(rows):
    def base(t):
        n = numbers(t)
        return n[0] < 20 or 100 * n[4] > 30 * n[0]
    held = defaultdict(list)
    for _, t, lang, source in rows:
        if not base(t):
            for key in (("g", lang, source), ("l", lang), ("a",)):
                held[key].append(rule_values(t))
    fence = {}
    for key, v in held.items():
        for k, rule in enumerate(RULES):
            n, (q1, q2, q3) = quartiles([x[k] for x in v])
            spread = 4 * max(q3 - q1, quality.LEAST_SPREAD[rule])
            fence[key, rule] = (n, q2 + spread, max(q2 - spread, 0))
    votes = {rule: sorted(f[1] for (key, x), f in fence.items() if key[0] == "g" and x == rule) for rule in RULES}
    cap = {rule: quality.CEILING * v[(len(v) - 1) // 2] for rule, v in votes.items() if v}
    mix = lambda n, own, wider: (n * own + quality.WEIGHT * wider) // (n + quality.WEIGHT)
    out = []
    for r in rows:
        if base(r[1]):
            continue
        ok = True
        for rule, v in zip(RULES, rule_values(r[1]), strict=True):
            g, lang, every = fence[("g", *r[2:4]), rule], fence[("l", r[2]), rule], fence[("a",), rule]
            high = min(mix(g[0], g[1], min(mix(lang[0], lang[1], every[1]), cap[rule])), cap[rule])
            low = mix(g[0], g[2], mix(lang[0], lang[2], every[2]))
            ok &= v <= high and (rule != "length" or v >= low)
        if ok:
            out.append(r)
    return out


def corpus():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [f"Shared line number {i}: " + prose(10) for i in range(5)]
    rows = []
    for i in range(260):
        lines = [prose(rnd.randrange(8, 20)) for _ in range(rnd.randrange(3, 8))]
        if i % 4 == 0:
            lines.insert(1, rnd.choice(shared))
        if i % 9 == 0:
            lines.insert(0, f'conf token = "{rnd.getrandbits(160):040x}" end')
        rows.append([i, "\n".join(lines), rnd.choice(["en", "de"]), rnd.choice(["s1", "s2"])])
    for i in range(260, 300):  # near and exact copies
        t = rows[i % 7][1].split(" ")
        if i % 3 and len(t) > 60:
            t[30] = "changed" + str(i)
        rows.append([i, " ".join(t), "en", "s1"])
    rows += [[300, prose(40).replace(" ", " ### "), "en", "s1"], [301, "Too short.", "en", "s1"], [302, None, "en", None],
             [303, prose(8) + " " + " ".join(["again and again we say the same words"] * 9), "de", "s2"],
             [304, prose(50).replace(" ", "!! "), "de", "s2"], [305, rows[5][1], None, None], [306, rows[5][1], "en", "s1"],
             [306, rows[5][1], "en", "s1"]]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(*r, len(r[1]) if r[1] is not None else None) for r in corpus()]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    return path


def test_pipeline_equals_brute_force(spark, folder):
    rows = brute_quality(corpus())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder))
        assert docs.columns == columns
        kept[name] = sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect() if r["lang"]) + [
            (r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect() if not r["lang"]]
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    order = lambda x: sorted(x, key=str)
    assert order(kept["quality"]) == order(rows)
    lang = {r[0]: r[2:4] for r in rows}
    rows = [(i, t, *lang[i]) for i, _, _, t in brute_lines(rows)]
    assert order(kept["line_dedup"]) == order(rows)
    comp = brute_components(rows)
    rows = list({r[0]: r for r in rows if comp[r[0]][1] == r[0]}.values())
    assert order(kept["near_dedup"]) == order(rows)
    rows = [(i, re.sub(r'(?<=token = ")[0-9a-f]{40}(?=")', "<SECRET>", t), *x) for i, t, *x in rows]
    assert order(kept["secrets"]) == order(rows)
    tk = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*tk.encode(t, add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    got, seqs = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        got[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: sum((x for _, x in sorted(p)), []) for i, p in got.items()} == want
    for p in seqs.values():
        assert [o for o, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1]] and sum(n for _, n in p) <= 2048


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder))
        assert docs.count() == 0
