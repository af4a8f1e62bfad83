"""Stored embeddings: fixed-width binary vectors with their norm and the model they came from.

A vector is one binary of little-endian 32-bit floats, so a batch of them is one matrix without rebuilding arrays, and
Parquet reads it as it is.  Models are partitions: reading one model touches only its files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "dim int, vec binary, norm double"


def write_embeddings(df: DataFrame, path: str, id_col: str, vec_col: str, model: str, mode: str = "overwrite") -> None:
    """Store (id, vector) rows under ``path`` as ``model``; rows without a vector, or with a null in it, are left out."""
    id_type = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vecs = [np.asarray(v, dtype="<f4") for v in b["v"]]
            yield pd.DataFrame({"id": b["id"], "dim": [len(v) for v in vecs], "vec": [v.tobytes() for v in vecs],
                                "norm": [float(np.sqrt((v.astype(np.float64) ** 2).sum())) for v in vecs]})
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(
        F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    rows.mapInPandas(run, f"id {id_type}, {COLUMNS}").write.mode(mode).parquet(f"{path.rstrip('/')}/model={model}")


def read_embeddings(spark: SparkSession, path: str, model: str) -> DataFrame:
    """(id, dim, vec, norm) of one model."""
    return spark.read.parquet(f"{path.rstrip('/')}/model={model}")


def vectors(stored: DataFrame) -> DataFrame:
    """(id, embedding array<float>) again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "embedding": [np.frombuffer(v, dtype="<f4") for v in b["vec"]]})
    return stored.mapInPandas(run, f"id {dict(stored.dtypes)['id']}, embedding array<float>")


def cosines(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, score) for every pair whose vectors are stored and of one dimension; 0 where a norm is 0.

    Both vectors travel as bytes; a batch is one product of two matrices per dimension.
    """
    side = lambda df, i, x: df.select(F.col("id").alias(i), F.col("dim").alias(f"d{x}"), F.col("vec").alias(f"v{x}"),
                                      F.col("norm").alias(f"n{x}"))
    joined = (pairs.select(left_id, right_id).join(side(left, left_id, "a"), left_id).join(side(right, right_id, "b"), right_id)
              .where("da = db"))
    types = dict(joined.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby("da"):
                a, c = (np.frombuffer(b"".join(g[k]), dtype="<f4").reshape(len(g), dim).astype(np.float64) for k in ("va", "vb"))
                norm = (g["na"] * g["nb"]).to_numpy()
                dot = (a * c).sum(axis=1)
                yield pd.DataFrame({left_id: g[left_id], right_id: g[right_id],
                                    "score": np.divide(dot, norm, out=np.zeros(len(g)), where=norm > 0)})
    return joined.mapInPandas(run, f"{left_id} {types[left_id]}, {right_id} {types[right_id]}, score double")
