import json
import random

import numpy as np
import public_tokenizers
import pytest

from graphweave.llm import bpe, packing

from .conftest import ODD, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "  a", "a  b", " a", "a\n b", "a \n b", "x" * 3000, " " * 500 + "a", "it's we'll", "<|endoftext|> a",
          "a <|endoftext|>b", "é　c a b", "日本語 テスト🙂 x", "a\tb \t c\r\n  d"]


def random_texts():
    rnd = random.Random(11)
    parts = [*"abcdeABCé日🙂 \n\t!'1", "  ", "'re", "the ", "ing", "\u0085", "\u2028", "\u00a0", "x" * 300, "  \n  ", "<|endoftext|>"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(300))) for _ in range(400)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    """By ranks where they are proven to give the file's ids, else by the library."""
    path = public_tokenizers.path(name)
    ranks, tk = bpe.rank_table(path), bpe.load(path)
    assert (ranks is not None) == (name == "byte_bpe_50k.json")
    enc = bpe.Encoder(path, ranks)
    texts = [*TRICKY, *random_texts(), "a" * 50_000, " " * 50_000 + "x", "ab!" * 20_000]
    for t, b in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids


def test_ranks_are_refused_where_they_differ(tmp_path):
    """A token that joins with smaller ids would form by other parts than those of its merge."""
    spec = json.loads(open(PATH, encoding="utf-8").read())
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    single = {c: i for c, i in vocab.items() if len(c) == 1}
    for pairs, proven in (([["a", "b"], ["ab", "c"]], True), ([["b", "c"], ["a", "b"], ["ab", "c"]], False), ([["ab", "c"], ["a", "b"]], False)):
        spec["model"]["vocab"] = single | {a + b: 256 + i for i, (a, b) in enumerate(pairs)}
        spec["model"]["merges"], spec["added_tokens"] = pairs, []
        path = tmp_path / f"{len(pairs)}{proven}.json"
        path.write_text(json.dumps(spec))
        assert (bpe.rank_table(str(path)) is not None) == proven
    assert len(single) == 256 and len(merges) + 256 == len(vocab)


def test_batches_hold_every_text_once():
    texts = ["a" * 5, None, "", "b" * 50, "c", "d" * 9, "e"]
    parts = list(bpe.sized_batches(texts, 10))
    assert [i for lo, hi in parts for i in range(lo, hi)] == list(range(len(texts)))
    assert all(hi - lo == 1 or sum(len(t or "") for t in texts[lo:hi]) <= 10 for lo, hi in parts)


def check(rows, pieces, window):
    tk = bpe.load(PATH)
    want = sorted((str(i), np.array([*tk.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows)
    got, seqs = {}, {}
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] > 0
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        got.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
    used = sum(n for p in seqs.values() for _, n in p)
    assert used == sum(len(b) // 4 for _, b in want)
    return want, got, seqs


def test_every_id_lies_in_one_piece(make_docs):
    rows = [(i, t, "en", "s") for i, t in enumerate(TRICKY)]
    rows += [(100 + i, words(30 + 37 * i % 900, i), "en", "s") for i in range(60)] + [(500, words(4000), "en", "s")]
    out = packing.pack(make_docs(rows), PATH).collect()
    want, got, seqs = check([r[:2] for r in rows], out, 2048)
    joined = sorted((i, b"".join(b for _, b in sorted(p))) for (i, _), p in got.items())
    assert joined == want
    for (_, n), p in got.items():
        at = 0
        for s, b in sorted(p):
            assert s == at
            at += len(b) // 4
        assert at == n


def test_odd_rows_and_empty_table(make_docs):
    out = packing.pack(make_docs(ODD), PATH).collect()
    assert sum(r["length"] for r in out if r["doc_id"] == 1) == 1
    assert sum(r["length"] == r["doc_tokens"] for r in out if r["doc_id"] == 5) == 2
    check([r[:2] for r in ODD], out, 2048)
    assert packing.pack(make_docs([]), PATH).count() == 0


def test_little_padding(spark):
    rng = np.random.default_rng(2)
    lengths = [(i, int(x)) for i, x in enumerate(np.concatenate([rng.integers(1, 6000, 3000), np.full(1500, 1337)]))]
    pieces = packing.place(spark.createDataFrame(lengths, "uid long, n long")).collect()
    seqs = {p["sequence_id"] for p in pieces}
    assert sum(n for _, n in lengths) / (2048 * len(seqs)) > 0.98
    assert len({(p["uid"], p["start"]) for p in pieces}) == len(pieces)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_least_squares_is_optimal_and_plan_fits(seed):
    rng = np.random.default_rng(seed)
    a, y = rng.random((12, 30)), rng.random(12)
    x = packing.nnls(a, y)
    slope = a.T @ (y - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max() < 1e-6
    hist = rng.integers(0, 500, 128)
    used = np.zeros(128, dtype=int)
    for combo, n in packing.plan_counts(hist):
        assert sum(combo) == 128 and len(combo) <= packing.DEPTH
        for b in combo:
            used[b - 1] += n
    assert (used <= hist).all() and used.sum() > 0.5 * hist.sum()


def test_combinations_are_complete():
    want = {(a, b, c)[:3] for a in range(1, 13) for b in range(0, a + 1) for c in range(0, b + 1) if a + b + c == 12}
    assert set(packing.combinations(12, 3)) == {tuple(x for x in w if x) for w in want}
