"""Training-data pipeline over ``documents``.

Stages, each written as Parquet and read again before the next one:

1. quality: documents that the quality rules reject go.
2. line_dedup: lines that five or more documents share go, except from the largest doc_id.
3. near_dedup: one document of each near-duplicate component stays.
4. secrets: secrets are replaced by ``<SECRET>``; every document stays.
5. packing: the token ids of what is left, packed into windows of 2,048.

All stages but the last return the columns of ``documents`` (``n_chars`` follows the
text).  Each function takes (spark, docs, sf_dir).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.llm import line_dedup, near_dedup, packing, quality, secret_scan
from graphweave.llm.common import materialise
from graphweave.llm.queries import BYTE_BPE, _tokenizer


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.dedup_lines(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(secret_scan.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are little-endian uint32."""
    return packing.pack(docs.select("doc_id", "text"), _tokenizer(BYTE_BPE))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

# Token ids and near-duplicate components have no SQL form; tests hold the
# pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
