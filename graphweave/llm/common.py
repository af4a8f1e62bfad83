"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.operators.common import scratch_path, stored as materialise

__all__ = ["as_row", "ascii_lower", "from_row", "materialise", "scratch_path", "spread", "table", "text_key"]

# The white space of the text contracts, [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer splits than cores out evenly (small inputs only;
    a large input already has many splits and is left as it is)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` does just that on pure ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def text_key(c: Column) -> list[Column]:
    """Two independent 64-bit hashes: a 128-bit key of a value."""
    return [F.xxhash64(c), F.xxhash64(F.lit(1), c)]


def as_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns as one struct, so that helper columns can't clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def from_row(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None, name: str = "_row",
             more: list[Column] | None = None) -> DataFrame:
    """The columns of ``as_row`` again, some replaced."""
    changed = changed or {}
    return df.select(*[(changed[c] if c in changed else F.col(name)[c]).alias(c) for c in columns], *(more or []))
