"""Technology enrichment re-expressed as a join.

The definitions, synonyms and keywords come from a stored table (produced by
whatever service the caller uses); replies are parsed with the JSON-array
rule (invalid JSON and the "I don't know" sentinel become empty arrays).  A
caller-supplied ``mapInPandas`` function can fill the table batch-wise; ``enrich_memo`` remembers its replies, so that no
name is asked for twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nested import parse_reply_array
from ..functions.text import normalize_text

ENRICHED_SCHEMA = "technology_name string, definition string, synonyms_reply string, keywords_reply string"


def enrich(techs: DataFrame, replies: DataFrame) -> DataFrame:
    """techs(technology_name, ...) left-join replies(technology_name, definition,
    synonyms_reply, keywords_reply): all columns of techs but those three, plus
    definition ('' when missing) and the two arrays."""
    r = replies.select("technology_name", F.col("definition").alias("__d"), F.col("synonyms_reply").alias("__s"),
                       F.col("keywords_reply").alias("__k"))
    own = [c for c in techs.columns if c not in ("definition", "synonyms", "keywords")]
    return (techs.select(*own).join(r, "technology_name", "left")
            .select(*own, F.coalesce("__d", F.lit("")).alias("definition"),
                    parse_reply_array("__s").alias("synonyms"), parse_reply_array("__k").alias("keywords")))


def enrich_with(techs: DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Fill the replies with ``fetch`` (pandas batch in -> batch with the
    ENRICHED_SCHEMA columns out), run per Arrow batch on the executors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fetch(b)
    replies = techs.select("technology_name").mapInPandas(run, ENRICHED_SCHEMA)
    return enrich(techs, replies)


MEMO_SCHEMA = "key string, definition string, synonyms_reply string, keywords_reply string"


def memo_key(name) -> "F.Column":
    """Key of a name: a hash of its normalized form."""
    return F.sha2(F.coalesce(normalize_text(name), F.lit("")), 256)


def enrich_memo(techs: DataFrame, path: str, fetch: Callable[[pd.DataFrame], pd.DataFrame], retries: int = 2,
                batch: int = 64) -> DataFrame:
    """``enrich`` with replies from ``fetch``, each distinct key asked for once over all runs.

    ``path`` is the shared folder of the memo: one folder per run, holding the replies that the run added.  Names with a known key
    don't reach ``fetch``; the others reach it once per key (their smallest spelling), in the order of the keys, in batches of
    ``batch`` names.  A batch that raises is tried ``retries`` times more; names without a reply in the end are not
    remembered, so the next run asks again.  The rows of ``techs`` keep all their columns.
    """
    spark = techs.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def memo() -> DataFrame:
        done = [f.getPath().toString() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        rows = spark.read.schema(MEMO_SCHEMA).parquet(*done) if done else spark.createDataFrame([], MEMO_SCHEMA)
        # two runs at the same time may both have asked for a key
        return rows.groupBy("key").agg(F.min(F.struct("definition", "synonyms_reply", "keywords_reply")).alias("r")).select("key", "r.*")

    def ask(names: pd.DataFrame) -> pd.DataFrame:
        for left in range(retries, -1, -1):
            try:
                return fetch(names[["technology_name"]].reset_index(drop=True))
            except Exception:  # noqa: BLE001  a service may fail in any way
                if left == 0:
                    return pd.DataFrame(columns=["technology_name", "definition", "synonyms_reply", "keywords_reply"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at:at + batch]
                got = ask(part)
                yield part.merge(got, on="technology_name")[["key", "definition", "synonyms_reply", "keywords_reply"]]

    keyed = techs.withColumn("__key", memo_key(F.col("technology_name")))
    names = keyed.groupBy(F.col("__key").alias("key")).agg(F.min("technology_name").alias("technology_name")).where("technology_name is not null")
    missing = (names.join(memo().select("key"), "key", "left_anti").select("key", "technology_name")
               .repartitionByRange("key").sortWithinPartitions("key"))
    missing.mapInPandas(run, MEMO_SCHEMA).write.parquet(f"{path.rstrip('/')}/run-{uuid.uuid4().hex}")
    known = memo().select(F.col("key").alias("__key"), "definition", "synonyms_reply", "keywords_reply")
    replies = keyed.select("technology_name", "__key").distinct().join(known, "__key").drop("__key")
    return enrich(techs, replies)
