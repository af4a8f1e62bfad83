import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from graphweave.llm import bpe, sentencepiece_codec, token_counts

from .conftest import ODD
from .test_packing import TRICKY

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rnd = random.Random(5)
    parts = ["a", "bc", " ", "  ", "\n", "'s", "<|endoftext|>", "<|end", "1", "é", "🙂", "\t", "!", "\r\n", "x" * 40]
    return [*TRICKY, *("".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 400))) for _ in range(150))]


@pytest.mark.parametrize("chunk,overlap", [(200, 40), (64, 33), (5000, 100)])
def test_spliced_counts_equal_whole_texts(chunk, overlap):
    texts, tk = odd_texts(), bpe.load(PATH)
    counter = token_counts.Counter(PATH, chunk, overlap, bpe.rank_table(PATH))
    got = counter.count(texts)
    assert [n for n, _, _ in got] == [len(tk.encode(t, add_special_tokens=False).ids) for t in texts]
    if chunk < 1000:
        assert any(c > 1 for _, c, _ in got) and any(w for _, _, w in got)


def test_count_rows(make_docs):
    out = token_counts.count_tokens(make_docs(ODD), PATH)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in out.collect())
    tk = bpe.load(PATH)
    assert got == sorted((str(i), len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ODD)
    assert token_counts.count_tokens(make_docs([]), PATH).count() == 0


def test_spans_equal_the_library_and_tile_the_text():
    codec = sentencepiece_codec.Codec(MODEL)
    texts = odd_texts()
    for t, (ids, a, b) in zip(texts, codec.encode(texts), strict=True):
        assert ids == [*codec.sp.encode(t), codec.eos]
        assert a[0] == 0 and b[-1] == len(t.encode()) and (a[1:] == b[:-1]).all()
        known = codec.sp.encode(t, return_type="offset_mapping", return_bytes=True)["offsets"]
        for i, span, x, y in zip(ids, known, a, b, strict=False):
            if not codec.sp.is_byte(i):
                assert tuple(span) == (x, y)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
def test_character_map_equals_the_library(rule):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = getattr(lib, "serialized_model_proto", None) or lib._normalizer.serialized_model_proto
    mine = sentencepiece_codec.Normalizer.of_model(proto())
    for t in [*odd_texts(), "ﬁ ① Å é  ｱｲｳ ﷺ ", "  Ａ  Ｂ ", " x​y", "ÀÉ ß"]:
        out, align = mine(t)
        assert out == lib.normalize(t).encode() and len(align) == len(out) + 1
        assert (align[1:] >= align[:-1]).all()


def test_encode_decode_rows(make_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = sentencepiece_codec.encode_documents(make_docs(ODD), MODEL, outputs=("ids", "starts", "ends"))
    out = sentencepiece_codec.decode_ids(out, MODEL)
    got = sorted((str(r["doc_id"]), tuple(r["ids"]), r["decoded"]) for r in out.collect())
    assert got == sorted((str(i), (*sp.encode(t or ""), 2), sp.decode([*sp.encode(t or ""), 2])) for i, t, *_ in ODD)
    assert hashlib.sha256(got[0][2].encode()).hexdigest()
    assert sentencepiece_codec.encode_documents(make_docs([]), MODEL).count() == 0
