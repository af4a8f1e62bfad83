"""Readers: JSON Lines, JSON arrays, CSV, Parquet, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.nested import parse_reply_array


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON Lines with a declared schema; blank lines are skipped by the reader."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file holding one JSON array of records (multi-line JSON)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """JSON Lines, or one JSON array when ``lines=False`` (chosen by argument)."""
    return read_jsonl(spark, path, schema) if lines else read_json_array(spark, path, schema)


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """CSV with a header; quoted fields may hold quotes and newlines.

    A file whose fields can hold newlines is one task (no reader can split it); for large
    data write Parquet between steps, or pass ``multi_line=False`` if no field holds one.
    """
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
            .option("escape", '"').option("quote", '"').option("encoding", encoding).csv(path))


def read_technology_list(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """One-column technology CSV; the column is named ``technology_name``
    whatever the header says."""
    df = (spark.read.option("header", True).option("quote", '"').option("encoding", encoding).csv(path))
    return df.select(F.col(df.columns[0]).alias("technology_name"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_papers(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    return read_json(spark, path, schemas.RAW_PAPER, lines)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company snapshot (one JSON array); a missing snapshot is an error."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(f"company snapshot not found: {path}")
    return read_json_array(spark, path, schemas.RAW_COMPANY)


def read_technology_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Definitions file (JSON array of records).  Synonyms / keywords are read
    as text: a JSON array, or the sentinel "I don't know" (-> empty array)."""
    raw = read_json_array(spark, path, schemas.TECH_DEFINITIONS_FILE)
    return raw.select(F.col("`Technology Name`").alias("technology_name"),
                      F.col("Definition").alias("definition"),
                      parse_reply_array("Synonyms").alias("synonyms"),
                      parse_reply_array("`Top Domain Keywords`").alias("keywords"))


def read_list_text(c) -> "F.Column":
    """A list stored as Python literal text (``['a', 'b']``) -> array<string>."""
    return F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})


def load_linking_inputs(spark: SparkSession, papers_csv: str, techs_csv: str, definitions: str | None):
    """Normalized papers, technologies and (optional) definitions, joined
    technologies <- definitions (left, missing definition -> '').  Definitions come
    from a JSON array or from a CSV (technology_name, definition, synonyms, keywords;
    lists as Python literals), told apart by the file name."""
    papers = read_csv(spark, papers_csv, schemas.NORMALIZED_PAPER)
    techs = read_technology_list(spark, techs_csv)
    if definitions is not None:
        if definitions.endswith(".csv"):
            raw = read_csv(spark, definitions, "technology_name string, definition string, synonyms string, keywords string")
            defs = raw.withColumns({c: F.coalesce(read_list_text(F.col(c)), F.array().cast("array<string>"))
                                    for c in ("synonyms", "keywords")})
        else:
            defs = read_technology_definitions(spark, definitions)
        techs = (techs.join(defs, "technology_name", "left")
                 .withColumn("definition", F.coalesce("definition", F.lit(""))))
    return papers, techs


def read_graph_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A written node or edge CSV again, every column as text, missing cells as ''."""
    df = read_csv(spark, path, ", ".join(f"`{c}` string" for c in columns))
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])
