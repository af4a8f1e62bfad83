"""SentencePiece encoding with original byte spans, and decoding.

The model's compiled character map (a double-array trie of replacements) is
applied by longest prefix; every normalised byte remembers the original byte it
came from.  The library gives the ids; the lengths of their pieces, laid along
the normalised text, project every piece to its span of original UTF-8 bytes.

Defined results: null and empty texts have the end id alone and decode to an
empty text; repeated rows are encoded separately; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.llm.common import spread

SPACE = "▁".encode()


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 0x7F) << shift
        shift += 7
        if c < 0x80:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = b[i:i + n], i + n
        yield key >> 3, value


class Normalizer:
    """Character map and white-space rules of a model's normalizer."""

    # Fields of the normalizer message in the public model format.
    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, squeeze: bool = True, escape: bool = True):
        self.dummy_prefix, self.squeeze, self.escape = dummy_prefix, squeeze, escape
        self.units: list[int] = []
        self.strings = b""
        if charsmap:
            size = int.from_bytes(charsmap[:4], "little")
            self.units = np.frombuffer(charsmap[4:4 + size], dtype="<u4").tolist()
            self.strings = charsmap[4 + size:]

    @classmethod
    def of_model(cls, model: bytes) -> Normalizer:
        spec = dict(_fields(next((v for k, v in _fields(model) if k == 3), b"")))
        return cls(spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)))

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes consumed) of the longest mapped prefix at ``at``."""
        units = self.units
        node = (units[0] >> 10) << ((units[0] & 0x200) >> 6)
        best = None
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                start = units[node] & 0x7FFFFFFF
                best = (self.strings[start:self.strings.index(b"\0", start)], i + 1 - at)
        return best

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the original byte of each of them (one entry more: the end)."""
        raw = text.encode("utf-8", "surrogatepass")
        if not self.units and not self.squeeze and self.escape:
            return self._identity(raw)
        out, align = bytearray(), []
        space = SPACE if self.escape else b" "
        if raw and self.dummy_prefix:
            out += space
            align += [0] * len(space)
        at, was_space, consumed = 0, self.squeeze, 0
        while at < len(raw):
            hit = self.longest(raw, at) if self.units else None
            if hit is None:
                n = 1
                while at + n < len(raw) and raw[at + n] & 0xC0 == 0x80:
                    n += 1
                hit = (raw[at:at + n], n)
            piece, n = hit
            if self.squeeze and was_space:
                piece = piece.lstrip(b" ")
            if piece:
                for c in piece:
                    new = space if c == 0x20 else bytes((c,))
                    out += new
                    align += [at] * len(new)
                was_space = self.squeeze and piece.endswith(b" ")
                consumed = at + n
            at += n
        consumed = len(raw) if not self.squeeze else consumed
        if self.squeeze:
            while out.endswith(space) and len(out) >= len(space):
                del out[-len(space):]
                consumed = align[-len(space)]
                del align[-len(space):]
        return bytes(out), np.array([*align, consumed], dtype=np.int64)

    def _identity(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        buf = np.frombuffer(raw, dtype=np.uint8)
        align = np.repeat(np.arange(len(raw)), np.where(buf == 0x20, len(SPACE), 1))
        body = raw.replace(b" ", SPACE)
        if raw and self.dummy_prefix:
            body, align = SPACE + body, np.concatenate([np.zeros(len(SPACE), dtype=np.int64), align])
        return body, np.append(align, len(raw))


class Codec:
    """One model: ids with spans, and texts from ids."""

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            self.normalize = Normalizer.of_model(f.read())
        n = self.sp.get_piece_size()
        self.unk, self.eos = self.sp.unk_id(), self.sp.eos_id()
        self.width = np.array([1 if self.sp.is_byte(i) else 0 if self.sp.is_control(i) else
                               len(self.sp.id_to_piece(i).encode()) for i in range(n)], dtype=np.int64)

    def spans(self, text: str, ids: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Original byte span of every piece; the pieces tile the normalised text."""
        _, align = self.normalize(text)
        width = self.width[np.asarray(ids, dtype=np.int64)] if len(ids) else np.zeros(0, dtype=np.int64)
        if self.unk in ids:  # an unknown run's length is its surface's
            surface = self.sp.encode(text, return_type=str)
            width = np.array([1 if self.sp.is_byte(i) else len(s.encode()) for i, s in zip(ids, surface, strict=True)])
        end = np.cumsum(width)
        return align[end - width], align[end]

    def encode(self, texts: list[str], end: bool = True) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
        out = []
        for text, ids in zip(texts, self.sp.encode(texts, num_threads=1) if texts else [], strict=True):
            a, b = self.spans(text, ids)
            if end:
                size = len(text.encode("utf-8", "surrogatepass"))
                ids, a, b = [*ids, self.eos], np.append(a, size), np.append(b, size)
            out.append((ids, a, b))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids, num_threads=1) if ids else []


OUTPUTS = {"ids": "array<int>", "starts": "array<int>", "ends": "array<int>", "decoded": "string"}


def encode_documents(documents: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     outputs: Sequence[str] = ("ids", "starts", "ends")) -> DataFrame:
    """Ids with an end id, original byte spans and, if asked for, the decoded text of every row."""
    id_type = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(model_path)
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.iloc[at:at + 64]
                got = codec.encode(part["text"].tolist())
                cols = {"id": part["id"].tolist()}
                if "ids" in outputs:
                    cols["ids"] = [np.array(x[0], dtype=np.int32) for x in got]
                if "starts" in outputs:
                    cols["starts"] = [x[1].astype(np.int32) for x in got]
                if "ends" in outputs:
                    cols["ends"] = [x[2].astype(np.int32) for x in got]
                if "decoded" in outputs:
                    cols["decoded"] = codec.decode([x[0] for x in got])
                yield pd.DataFrame(cols)

    rows = spread(documents.select(F.col(id_col).cast("string").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")))
    out = rows.mapInPandas(run, ", ".join(["id string", *(f"{c} {OUTPUTS[c]}" for c in OUTPUTS if c in outputs)]))
    return out.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Text of every id list, as a column beside the others."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(model_path)
        for ids in batches:
            yield pd.Series(codec.decode([[int(i) for i in x] if x is not None else [] for x in ids]))
    return encoded.withColumn(out_col, run(F.col(ids_col)))
