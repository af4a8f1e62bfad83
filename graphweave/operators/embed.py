"""Text -> unit embedding.

The neural sentence encoder of the original is a single-machine model; here
the encoder is a caller-supplied batch function run with ``mapInPandas``.
The default is a deterministic feature-hashing encoder (signed hashing of
lower-cased word tokens into ``dim`` buckets), a stand-in that keeps the
job runnable without a model.  Vectors are L2-normalized.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = __import__("re").compile(r"\w\w+", __import__("re").UNICODE)


def hashing_encoder(dim: int = 256) -> Callable[[list[str]], np.ndarray]:
    def enc(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for tok in TOKEN.findall((t or "").lower()):
                h = zlib.crc32(tok.encode("utf-8"))
                out[i, h % dim] += 1.0 if (h >> 31) & 1 else -1.0
        return out
    return enc


def embed(df: DataFrame, id_col: str, text_col: str, encoder: Callable[[list[str]], np.ndarray] | None = None,
          out_col: str = "embedding") -> DataFrame:
    """(id, embedding array<float>) for every row, L2-normalized (zero stays zero)."""
    enc = encoder or hashing_encoder()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = enc(b[text_col].fillna("").tolist()).astype(np.float64)
            n = np.linalg.norm(v, axis=1, keepdims=True)
            v = np.divide(v, n, out=np.zeros_like(v), where=n > 0)
            yield pd.DataFrame({id_col: b[id_col], out_col: list(v.astype(np.float32))})
    schema = f"{id_col} {dict(df.dtypes)[id_col]}, {out_col} array<float>"
    return df.select(F.col(id_col), F.col(text_col)).mapInPandas(run, schema)
