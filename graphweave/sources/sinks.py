"""Writers: JSON Lines, CSV (with header, chosen columns), Parquet."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, UTF-8, nulls written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON records: every part file is one JSON array, a record per line, so that no task holds more than a line.  (A table
    without partitions gives one empty file, which the readers take as no records.)"""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            lines = b["value"].tolist()
            if lines:
                out = [] if last is None else [last + ","]
                yield pd.DataFrame({"value": (["["] if last is None else []) + out + [x + "," for x in lines[:-1]]})
                last = lines[-1]
        yield pd.DataFrame({"value": ["[]"] if last is None else [last, "]"]})
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))
    rows.mapInPandas(run, "value string").write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite",
              blank_zero: list[str] | None = None) -> None:
    """CSV with header.  Arrays are joined by '; '; the columns in
    ``blank_zero`` write 0 as an empty field.  An empty DataFrame still gets
    its header (Spark writes it in an empty part file)."""
    out = df.select(*(columns or df.columns))
    for f in out.schema.fields:
        if isinstance(f.dataType, ArrayType):
            out = out.withColumn(f.name, F.array_join(F.col(f.name), "; "))
        elif isinstance(f.dataType, StructType):
            out = out.withColumn(f.name, F.to_json(F.col(f.name)))
    for c in blank_zero or []:
        out = out.withColumn(c, F.when(F.col(c) != 0, F.col(c).cast("string")).otherwise(F.lit("")))
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def company_csv(companies: DataFrame) -> DataFrame:
    """3-column company table from nested records, blanks for missing values."""
    p = "properties"
    return companies.select(F.coalesce(F.col(f"{p}.identifier.value"), F.lit("")).alias("identifier.value"),
                            F.coalesce(F.col(f"{p}.identifier.permalink"), F.lit("")).alias("identifier.permalink"),
                            F.coalesce(F.col(f"{p}.description"), F.lit("")).alias("description"))
