"""Removal of lines that many documents share.

Lines are split at ``\\n`` and normalised (white space stripped at both ends,
A-Z lower-cased); the key is a 128-bit hash.  A key of at least ``min_chars``
code points that ``min_docs`` or more documents hold loses its lines everywhere
but in the document with the largest id.  The kept lines are joined by position.

Plan: each document explodes its long line keys once; distinct documents per key
are counted with partial aggregation on both levels, so a key that every
document holds is one row per task.  The (small) table of shared keys is
written to the shared folder; its true size then decides between a broadcast
and a split-able sort-merge join.  Only positions travel back to the documents.

Defined results: a null or empty text is one empty line; documents with a null
id count as one document that is smaller than any other; repeated ids count
once; rows that repeat id and text are treated alike; an empty table gives an
empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.llm.common import WS, as_row, ascii_lower, from_row, materialise, text_key

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, t1, t2, pos, h1, h2) of every line whose key has ``min_chars`` code points."""
    text = F.col(text_col)
    t1, t2 = text_key(text)
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    key = F.btrim(F.col("line"), F.lit(WS))
    h1, h2 = text_key(F.col("key"))
    return (documents.where(F.char_length(text) >= min_chars)
            .select(F.col(id_col).alias("id"), t1.alias("t1"), t2.alias("t2"),
                    F.posexplode(F.split(lowered, "\n", -1)).alias("pos", "line"))
            .select("id", "t1", "t2", "pos", key.alias("key"))
            .where(F.char_length("key") >= min_chars)
            .select("id", "t1", "t2", "pos", h1.alias("h1"), h2.alias("h2")))


def shared_keys(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, keeper) of the keys that at least ``min_docs`` documents hold."""
    return (keys.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
            .where(F.col("n_docs") >= min_docs))


def dropped_positions(keys: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, t1, t2, drop): positions that each distinct document row loses."""
    return (keys.join(shared.select("h1", "h2", "keeper"), ["h1", "h2"])
            .where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("drop")))


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """Documents with ``text_col`` replaced by the kept lines; ``counts`` names two more
    columns: lines before, and lines dropped."""
    keys = line_keys(documents, id_col, text_col, min_chars)
    shared = materialise(shared_keys(keys, min_docs))
    drops = dropped_positions(keys, shared)
    text = F.col("_row")[text_col]
    k1, k2 = text_key(text)
    joined = as_row(documents).withColumns({"_k1": k1, "_k2": k2}).join(
        drops, F.col("_row")[id_col].eqNullSafe(F.col("id")) & (F.col("_k1") == F.col("t1"))
        & (F.col("_k2") == F.col("t2")), "left")
    # the lines are pinned as a column first (two uses), else each position would split the text again
    pinned = joined.withColumn("_lines", F.when(F.col("drop").isNotNull(), _lines(text)))
    kept_at = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("drop"))
    kept = F.array_join(F.transform(kept_at, lambda i: F.get(F.col("_lines"), i)), "\n")
    new = F.when(F.col("drop").isNotNull(), kept).otherwise(F.coalesce(text, F.lit("")))
    more = [] if counts is None else [
        F.size(_lines(text)).cast("long").alias(counts[0]),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias(counts[1])]
    return from_row(pinned, documents.columns, {text_col: new}, more=more)
