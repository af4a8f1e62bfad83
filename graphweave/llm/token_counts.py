"""Token counts of whole texts by overlap resynchronisation.

A huge text is encoded in overlapping chunks with offsets, so that no call
holds more than a chunk.  Two neighbouring chunks are spliced at a boundary
that is proven stable: a place inside the overlap where both chunks start a new
pre-token, at least two characters after the right chunk's start and more than
the longest special string before the left chunk's end.  The pre-tokenizer scans
from left to right without memory, so from a common boundary on both scans
are the same as that of the whole text, and pre-tokens are encoded
independently of each other.  If the overlap holds no such place (a word or a
run of white space longer than the overlap), the overlap is widened, at last
to the union of both chunks.

Texts of at most one chunk need no splice; they are encoded whole (``bpe.Encoder``).  Tokenizers other than
byte-level BPE with the standard pattern are always given whole texts.

Defined results: null and empty texts have no tokens; repeated rows and ids are
counted separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.llm import bpe
from graphweave.llm.common import spread

CHUNK = 16_384
OVERLAP = 512


class Counter:
    """Counts tokens of texts with one tokenizer file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, ranks: dict | None = None):
        enc = bpe.shared_encoder(path, ranks)
        self.whole, self.tk, self.cuttable = enc, enc.tk, enc.cuttable
        self.margin = 3 + max([1, *(len(s) for s in enc.special)])
        self.chunk, self.overlap = chunk, max(overlap, 2 * self.margin)

    def _boundaries(self, enc, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Start of every token in the whole text, and which tokens start a pre-token."""
        off = np.array(enc.offsets, dtype=np.int64).reshape(-1, 2)[:, 0] + at
        word = np.array([-1 if w is None else w for w in enc.word_ids], dtype=np.int64)
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (word[1:] < 0) | (word[:-1] < 0)
        return off, new

    def _encode(self, text: str, spans: list[tuple[int, int]]) -> list[tuple]:
        encs = self.tk.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False)
        return [(a, b, *self._boundaries(e, a)) for e, (a, b) in zip(encs, spans, strict=True)]

    def _common(self, left: tuple, right: tuple) -> int | None:
        """A boundary that both chunks prove, or None."""
        _, l_end, l_off, l_new = left
        r_at, r_end, r_off, r_new = right
        lim = l_end - self.margin
        a = l_off[l_new & (l_off <= lim) & (l_off >= r_at + 2)]
        b = r_off[r_new & (r_off <= min(lim, r_end - self.margin)) & (r_off >= r_at + 2)]
        both = np.intersect1d(a, b, assume_unique=False)
        return int(both[-1]) if len(both) else None

    def spliced(self, text: str) -> tuple[int, int, int]:
        """(tokens, chunks, widenings) of a text longer than one chunk."""
        step = self.chunk - self.overlap
        spans = [(a, min(len(text), a + self.chunk)) for a in range(0, max(1, len(text) - self.overlap), step)]
        chunks = self._encode(text, spans)
        total, widened, begin = 0, 0, 0
        cur = chunks[0]
        for right in chunks[1:]:
            cut, wide = self._common(cur, right), self.overlap
            while cut is None or cut < begin:
                widened += 1
                wide *= 4
                if wide < self.chunk:
                    right = self._encode(text, [(max(cur[0], cur[1] - wide), right[1])])[0]
                    cut = self._common(cur, right)
                else:
                    cur = self._encode(text, [(cur[0], right[1])])[0]
                    break
            else:
                total += int(((cur[2] >= begin) & (cur[2] < cut)).sum())
                cur, begin = right, cut
        total += int((cur[2] >= begin).sum())
        return total, len(spans), widened

    def count(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(texts)
        short = [i for i, t in enumerate(texts) if t and (len(t) <= self.chunk or not self.cuttable)]
        for i, ids in zip(short, self.whole.encode([texts[i] for i in short]), strict=True):
            out[i] = (len(ids) // 4, 1, 0)
        for i, t in enumerate(texts):
            if t and len(t) > self.chunk and self.cuttable:
                out[i] = self.spliced(t)
        return out


def count_tokens(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens, n_chunks, n_widened) of every row."""
    held = documents.sparkSession.sparkContext.broadcast(bpe.rank_table(tokenizer_path))
    id_type = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(tokenizer_path, chunk, overlap, held.value)
        for b in batches:
            for lo, hi in bpe.sized_batches(b["text"].tolist()):
                part = b.iloc[lo:hi]
                n = counter.count(part["text"].tolist())
                yield pd.DataFrame({"id": part["id"], "n_bytes": part["n_bytes"], "n_tokens": [x[0] for x in n],
                                    "n_chunks": [x[1] for x in n], "n_widened": [x[2] for x in n]})

    rows = spread(documents.select(F.col(id_col).cast("string").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")))
    out = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInPandas(
        run, "id string, n_bytes long, n_tokens long, n_chunks long, n_widened long")
    return out.withColumn("id", F.col("id").cast(id_type)).withColumnRenamed("id", id_col)
