"""Incremental paper cleaning with Structured Streaming.

The batch job reads raw paper records (JSON Lines) and writes cleaned ones;
this is the same transformation as a stream over a folder that receives new
JSON Lines files: each micro-batch is cleaned and appended to the sink.
Stateless, so exactly-once comes from the file source offsets plus the file
sink's commit log under the checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import nested as N


def clean_papers(raw: DataFrame) -> DataFrame:
    """Slim authors/keywords/topics, unique institutions and topic levels,
    abstract rebuilt from the inverted index (null when the index is null),
    index dropped."""
    return (raw.withColumn("abstract", N.text_from_inverted_index("abstract_inverted_index"))
            .select("id", "doi", "title", "publication_date", "cited_by_count",
                    N.slim_authors("authorships").alias("authorships_c"),
                    N.paper_institutions("authorships").alias("institutions"),
                    N.slim_keywords("keywords").alias("keywords_c"),
                    N.slim_topics("topics").alias("topics_c"),
                    N.topic_level("topics", "subfield").alias("subfields"),
                    N.topic_level("topics", "field").alias("fields"),
                    N.topic_level("topics", "domain").alias("domains"),
                    "abstract")
            .withColumnRenamed("authorships_c", "authorships")
            .withColumnRenamed("keywords_c", "keywords")
            .withColumnRenamed("topics_c", "topics"))


def start_cleaning_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                          trigger_once: bool = False) -> StreamingQuery:
    """Stream JSON Lines files from ``in_dir``, write cleaned JSON Lines to
    ``out_dir``.  ``checkpoint`` must be on shared storage."""
    raw = spark.readStream.schema(schemas.RAW_PAPER).json(in_dir)
    cleaned = clean_papers(raw).withColumn("ingested_at", F.current_timestamp())
    w = (cleaned.writeStream.format("json").option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
