"""Byte-level BPE ids inside tasks, as the ``tokenizers`` library gives them.

A byte-level BPE whose merges stand in the order of their ids can be applied from the ranks of its tokens alone: join the
neighbours whose joint token has the smallest id.  This is the same process exactly if every token, taken apart that way
with only smaller ids, ends in the two parts of its own merge (then, whenever two neighbours form a token, they are that merge).
``rank_table`` proves this for a file; where it holds and the pre-tokenizer is the standard one, ``tiktoken`` gives the
same ids several times faster.  Texts that hold an added token's string, and all other files, go to ``tokenizers``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

BATCH_CHARS = 8 << 20
# Fixed value: the pattern of the standard byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load(path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(path)
    tk.no_truncation()
    tk.no_padding()
    return tk


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _standard(spec: dict) -> bool:
    """Byte-level BPE with the standard pattern and nothing around it."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (spec.get("normalizer") is None and spec.get("post_processor") is None
            and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
            and model.get("type") == "BPE" and not any(model.get(k) for k in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))


def _bytes_of() -> dict[str, int]:
    """Byte that each character of a byte-level token stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _parts(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """``token`` by joins of neighbours, smallest id first, with ids under ``below`` only."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 1:
        found = [(ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(found)
        if rank >= below:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


@lru_cache(maxsize=4)
def rank_table(path: str) -> dict[bytes, int] | None:
    """Ids of all tokens by their bytes, if ranks alone give this file's ids (see above), else None."""
    spec = _spec(path)
    if not _standard(spec):
        return None
    byte = _bytes_of()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    try:
        ranks = {bytes(byte[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in added}
    except KeyError:
        return None
    last = -1
    for pair in spec["model"]["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        a, b = bytes(byte[c] for c in a), bytes(byte[c] for c in b)
        rank = ranks.get(a + b)
        if rank is None or rank <= last or _parts(a + b, ranks, rank) != [a, b]:
            return None
        last = rank
    if len(spec["model"]["merges"]) + 256 != len(ranks) or not all(bytes([b]) in ranks for b in range(256)):
        return None
    return ranks


def sized_batches(texts: list[str | None], size: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``size`` characters together (at least one text)."""
    lo, n = 0, 0
    for i, t in enumerate(texts):
        if i > lo and n + len(t or "") > size:
            yield lo, i
            lo, n = i, 0
        n += len(t or "")
    if lo < len(texts):
        yield lo, len(texts)


class Encoder:
    """``encode(texts)`` -> one little-endian uint32 ``bytes`` of ids per text.

    ``ranks``: the file's rank table where it has one (computed once on the driver).
    """

    def __init__(self, path: str, ranks: dict[bytes, int] | None):
        self.tk = load(path)
        spec = _spec(path)
        self.cuttable = _standard(spec)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = None
        if ranks is not None:
            import tiktoken
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole = []
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.fast is None or any(s in t for s in self.special):
                whole.append(i)
            else:
                out[i] = self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4", copy=False).tobytes()
        encs = self.tk.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False) if whole else []
        for i, e in zip(whole, encs, strict=True):
            out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out


_shared: dict[str, Encoder] = {}


def shared_encoder(path: str, ranks: dict[bytes, int] | None) -> Encoder:
    """The encoder of this Python worker: one serves all tasks that the worker runs."""
    if path not in _shared:
        _shared.clear()
        _shared[path] = Encoder(path, ranks)
    return _shared[path]
