"""Schema-time projections: keep the columns that exist, add missing ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep only the wanted columns that the input has (in the wanted order)."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def ensure_column(df: DataFrame, name: str, default: str = "") -> DataFrame:
    """Add ``name`` with a default value when the input lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def rename_company_columns(df: DataFrame) -> DataFrame:
    """Company name and description out of nested company records."""
    return df.select(F.col("properties.identifier.value").alias("company_name"),
                     F.col("properties.short_description").alias("description"))
