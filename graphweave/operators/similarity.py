"""Similarity signals between entities and technologies.

* ``tfidf_similarity``   — word 1-2-gram TF-IDF cosine over a joint corpus.
* ``cosine_scores``      — cosine of all embedding vectors with all technology
                           vectors, block by block (Arrow + BLAS).
* ``label_centroids``    — unit-normalized mean vector per label.
* ``keyword_overlap``    — exact keyword-set intersection as an exploded equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from .common import BROADCAST_MAX_ROWS, broadcast_if_small, fits_broadcast, stored

TOKEN_PATTERN = r"(?U)\b\w\w+\b"


def with_ngram_terms(df: DataFrame, text: str, out: str = "terms") -> DataFrame:
    """Add ``out``: lower-cased word tokens of two or more word characters,
    English stop words removed, then unigrams + bigrams of the remaining
    tokens (bigrams are formed *after* stop-word removal).

    Token arrays are separate projections referenced twice, so the optimizer
    keeps each computed once per row instead of inlining it into every use.
    """
    p = f"__{out}_"
    d = df.withColumn(p + "t", F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))),
                                                     F.lit(TOKEN_PATTERN), 0))
    d = d.withColumn(p + "k", F.when(F.col(p + "t").isNotNull(),
                                     F.filter(p + "t", lambda t: ~t.isin(ENGLISH))))
    k = F.col(p + "k")
    n1 = F.greatest(F.size(k) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(k, 1, n1), F.slice(k, 2, n1), lambda a, b: F.concat_ws(" ", a, b))
    return d.withColumn(out, F.concat(k, bigrams)).drop(p + "t", p + "k")


COUNT_ROWS = 512


def term_counts(df: DataFrame, text: str) -> DataFrame:
    """Rows of ``df`` with ``tf`` (term, tf; in term order) in place of ``text``: the terms of ``with_ngram_terms`` and their counts.

    Words come from Spark's expression; stop words, bigrams and counts are taken on their numbers, batch by batch in Arrow, and a
    string is formed once per different term of a batch.
    """
    rest = [c for c in df.columns if c != text]
    words = df.select(*rest, F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKEN_PATTERN), 0).alias("__w"))
    schema = df.select(*rest).withColumn("tf", F.lit(None).cast("array<struct<term:string,tf:int>>")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, COUNT_ROWS):
                part = batch.slice(lo, COUNT_ROWS)
                held = part.column("__w")
                held = held.cast(pa.list_(pa.string()))
                tf = _count_lists(held.flatten(), pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), tf], names=[*rest, "tf"])
    return words.mapInArrow(count, schema)


def _count_lists(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Per list of words (all lists flattened, and their sizes): its uni- and bigrams without stop words, and their counts."""
    coded = words.dictionary_encode()
    known, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    stop = pc.is_in(known, value_set=pa.array(ENGLISH, pa.string())).to_numpy(zero_copy_only=False)
    keep = ~stop[code] if len(code) else np.zeros(0, dtype=bool)
    code, row = code[keep], row[keep]
    near = row[1:] == row[:-1]
    pair, at = np.unique(code[:-1][near] * max(1, len(known)) + code[1:][near], return_inverse=True)
    first, second = (known.take(pa.array(x)) for x in np.divmod(pair, max(1, len(known))))
    terms = pa.concat_arrays([known, pc.binary_join_element_wise(first, second, " ")])
    # places of the terms in their order; the same term never comes twice, as a word has no blank
    order = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    width = max(1, len(terms))
    key = np.concatenate([row * width + rank[code], row[1:][near] * width + rank[at.reshape(-1) + len(known)]])
    found, n = np.unique(key, return_counts=True)
    of, place = np.divmod(found, width)
    offsets = np.searchsorted(of, np.arange(len(sizes) + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([terms.take(pa.array(order[place])), pa.array(n.astype(np.int32))], names=["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _exploded(counted: DataFrame) -> DataFrame:
    """(side, id, term, tf): one row per document and term."""
    return counted.select("side", "id", F.explode("tf").alias("x")).select("side", "id", "x.term", "x.tf")


def tfidf_similarity(entities: DataFrame, techs: DataFrame, entity_id: str = "entity_id",
                     tech_id: str = "tech_id", text: str = "text", max_features: int = 5000,
                     pairs: DataFrame | None = None, threshold: float | None = None) -> DataFrame:
    """Cosine of L2-normalized TF-IDF vectors, fitted on technologies and
    entities together: tf = raw count, idf = ln((1+n)/(1+df)) + 1, vocabulary =
    the ``max_features`` terms with the largest corpus count (ties: term order).

    Returns ``(entity_id, tech_id, tfidf)`` for pairs that share a term; with
    ``pairs`` (entity_id, tech_id) only for those, joined on (technology, term)
    so that a frequent term never meets all technologies; with ``threshold`` (above 0) only for pairs that reach it.  Then
    the candidates are the pairs that share a term of both prefixes: a document's terms stand from rare to frequent, and
    its prefix ends where the norm of what is left falls under the threshold.  A pair that shares only terms after the prefix of
    one side can't reach it, as its cosine is at most the norm of that rest; frequent terms are seldom in a prefix.
    Plan: term counts inside each row (no shuffle); one term aggregate with
    map-side combine; a top-k vocabulary (bounded by ``max_features``,
    broadcast); one per-document group of term numbers and counts for the L2 norm; an equi-join on the
    term.  Technologies that pass the size check are broadcast and a document's pairs
    are summed up beside its terms; else the joined rows are shuffled by pair.
    """
    # ids of either side may be strings or numbers: carried as text inside and
    # cast back to the callers' types at the end (exact for integers)
    e_type, t_type = dict(entities.dtypes)[entity_id], dict(techs.dtypes)[tech_id]
    corpus = (entities.select(F.lit(0).alias("side"), F.col(entity_id).cast("string").alias("id"), F.col(text).alias("text"))
              .unionByName(techs.select(F.lit(1).alias("side"), F.col(tech_id).cast("string").alias("id"),
                                        F.col(text).alias("text"))))
    n_docs = corpus.count()
    # per-document (term, tf) arrays feed both the term statistics and the
    # weights; stored in the shared folder so the tokenizer runs once
    counted = stored(term_counts(corpus, "text"))
    tf = _exploded(counted)
    stats = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    top = stored(stats.orderBy(F.desc("total"), F.asc("term")).limit(max_features))
    vocab = (top.withColumn("no", F.row_number().over(Window.orderBy(F.desc("total"), F.asc("term"))))
             .select("term", "df", "no", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf")))
    vocab = stored(vocab)
    if pairs is not None:
        # only the documents that are asked for get weights
        ids = pairs.select(F.col(entity_id).cast("string").alias("id")).distinct()
        tf = _exploded(counted.where("side = 1").unionByName(counted.where("side = 0").join(ids, "id", "left_semi").select(*counted.columns)))
    # a term travels as one number: its place in the vocabulary above its count
    square = F.pow(F.col("tf") * F.col("idf"), F.lit(2.0))
    packed = F.shiftleft(F.col("no").cast("long"), 32) + F.col("tf").cast("long")
    per_doc = (tf.join(F.broadcast(vocab.select("term", "no", "idf")), "term").select("side", "id", packed.alias("x"), square.alias("s"))
               .groupBy("side", "id").agg(F.collect_list("x").alias("tw"), F.sqrt(F.sum("s")).alias("nrm")))
    wn = (per_doc.select("side", "id", F.explode("tw").alias("x"), "nrm")
          .select("side", "id", F.shiftright("x", 32).cast("int").alias("no"), F.col("x").bitwiseAND(F.lit((1 << 32) - 1)).alias("tf"), "nrm")
          .join(F.broadcast(vocab), "no").select("side", "id", "term", (F.col("tf") * F.col("idf") / F.col("nrm")).alias("wn"), "df"))
    if pairs is None:
        # the weighted technologies are stored first, so the check of their rows and bytes doesn't run the job twice
        small = stored(wn.where("side = 1"))
        if fits_broadcast(small, BROADCAST_MAX_ROWS * 5):
            return _beside_documents(wn.where("side = 0"), small, threshold).select(
                F.col("id").cast(e_type).alias(entity_id), F.col("tech").cast(t_type).alias(tech_id), "tfidf")
    if threshold is not None:
        wn = stored(wn)
        pairs = _prefix_pairs(wn, threshold, entity_id, tech_id)
    ent = wn.filter(F.col("side") == 0).select(F.col("id").alias(entity_id), "term", F.col("wn").alias("we"))
    tec = wn.filter(F.col("side") == 1).select(F.col("id").alias(tech_id), "term", F.col("wn").alias("wt"))
    if pairs is not None:
        asked = pairs.select(F.col(entity_id).cast("string").alias(entity_id),
                             F.col(tech_id).cast("string").alias(tech_id)).distinct()
        joined = asked.join(ent, entity_id).join(tec, [tech_id, "term"])
    else:
        joined = ent.join(tec, "term")
    out = (joined.groupBy(entity_id, tech_id).agg(F.sum(F.col("we") * F.col("wt")).alias("tfidf"))
           .select(F.col(entity_id).cast(e_type).alias(entity_id), F.col(tech_id).cast(t_type).alias(tech_id), "tfidf"))
    return out if threshold is None else out.where(F.col("tfidf") >= threshold)


def _beside_documents(documents: DataFrame, techs: DataFrame, threshold: float | None) -> DataFrame:
    """(id, tech, tfidf) with few enough technologies for a broadcast: the pairs of a document arise and are summed up
    where its terms are, so no pair is shuffled; with ``threshold`` those that share a term of both prefixes and reach it."""
    keep = []
    if threshold is not None:
        documents, techs = (_with_heads(x, threshold) for x in (documents, techs))
        keep = [F.max(F.col("head") & F.col("thead")).alias("head")]
    t = techs.select(F.col("id").alias("tech"), "term", F.col("wn").alias("wt"), *([F.col("head").alias("thead")] if keep else []))
    # ``side`` stays a key: rows are dealt by (side, id) already
    out = (documents.join(F.broadcast(t), "term").groupBy("side", "id", "tech")
           .agg(F.sum(F.col("wn") * F.col("wt")).alias("tfidf"), *keep))
    return out if threshold is None else out.where(F.col("head") & (F.col("tfidf") >= threshold))


def _with_heads(weights: DataFrame, threshold: float) -> DataFrame:
    """Add ``head``: the term is in its document's prefix, after which the squared norm of the rest is under the threshold's."""
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    before = Window.partitionBy("side", "id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.lit(1.0) - F.coalesce(F.sum(F.col("wn") * F.col("wn")).over(before), F.lit(0.0))
    # with room for rounding
    return weights.withColumn("head", rest >= threshold * threshold - 1e-9)


def _prefix_pairs(weights: DataFrame, threshold: float, entity_id: str, tech_id: str) -> DataFrame:
    """(entity_id, tech_id) that share a term of both prefixes, from (side, id, term, wn, df)."""
    heads = stored(_with_heads(weights, threshold).where("head").select("side", "id", "term"))
    e = heads.where("side = 0").select(F.col("id").alias(entity_id), "term")
    t = heads.where("side = 1").select(F.col("id").alias(tech_id), "term")
    return e.join(t, "term").select(entity_id, tech_id).distinct()


def label_centroids(df: DataFrame, label: str, vec: str, out_vec: str = "vec") -> DataFrame:
    """Mean vector per label, L2-normalized.  Averaging runs per (label, dim)
    with partial aggregation; the result holds one bounded row per label."""
    exploded = df.select(F.col(label), F.posexplode(F.col(vec)).alias("dim", "x"))
    means = exploded.groupBy(label, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vecs = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("dim", "m"))).alias("pairs"))
    v = F.transform(F.col("pairs"), lambda p: p["m"])
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return vecs.select(F.col(label), F.transform(v, lambda x: x / norm).alias(out_vec))


# Scores held at once by one task, and vectors per block of either side.
SCORE_CELLS = 1 << 22
VECTOR_BLOCK = 4096


def _unit_rows(vectors) -> np.ndarray:
    """Rows scaled to length one; a zero vector stays zero (its cosines are 0)."""
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def cosine_scores(entities: DataFrame, techs: DataFrame, entity_id: str, entity_vec: str,
                  tech_id: str, tech_vec: str, min_score: float | None = None,
                  block: int = VECTOR_BLOCK) -> DataFrame:
    """Cosine of every entity vector with every technology vector.

    Both sides are cut into blocks by a hash of the id; a block of entities meets
    every block of technologies in an equi-join of block numbers and is scored with
    matrix products of at most ``SCORE_CELLS`` cells, so neither side has to fit one
    task or the driver.  The number of blocks follows from the counts.  Only pairs
    with ``score >= min_score`` are emitted when ``min_score`` is given.  Null
    vectors take no part, a zero vector scores 0.  Output ``(entity_id, tech_id, score)``.
    """
    e_type = dict(entities.dtypes)[entity_id]
    t_type = dict(techs.dtypes)[tech_id]
    left = entities.select(F.col(entity_id).alias("id"), F.col(entity_vec).alias("v")).where("v is not null")
    right = techs.select(F.col(tech_id).alias("id"), F.col(tech_vec).alias("v")).where("v is not null")
    nl, nr = (max(1, -(-x.count() // block)) for x in (left, right))
    cell = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # a block of one side meets many of the other: entities are spread over all cores all the same
    fan = max(1, -(-entities.sparkSession.sparkContext.defaultParallelism // (nl * nr)))
    left = left.withColumns({"i": cell(nl * fan)}).withColumn("j", every(nr))
    right = right.withColumns({"j": cell(nr)}).withColumn("i", every(nl * fan))
    schema = f"{entity_id} {e_type}, {tech_id} {t_type}, score double"

    def score(e: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        rows, cols, vals = [], [], []
        if len(e) and len(t):
            m = _unit_rows(t["v"])
            step = max(1, SCORE_CELLS // len(t))
            for at in range(0, len(e), step):
                s = _unit_rows(e["v"].iloc[at:at + step]) @ m.T
                r, c = np.nonzero(s >= min_score) if min_score is not None else np.nonzero(np.ones(s.shape, dtype=bool))
                rows.append(r + at)
                cols.append(c)
                vals.append(s[r, c])
        r = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
        c = np.concatenate(cols) if cols else np.empty(0, dtype=np.int64)
        return pd.DataFrame({entity_id: e["id"].to_numpy()[r], tech_id: t["id"].to_numpy()[c],
                             "score": np.concatenate(vals) if vals else np.empty(0)})

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(score, schema)


def cosine_pairs(pairs: DataFrame, entities: DataFrame, techs: DataFrame, entity_id: str, entity_vec: str,
                 tech_id: str, tech_vec: str) -> DataFrame:
    """Cosine of the given (entity_id, tech_id) pairs only, inside the JVM."""
    left = entities.select(F.col(entity_id), F.col(entity_vec).alias("__a")).where("__a is not null")
    right = techs.select(F.col(tech_id), F.col(tech_vec).alias("__b")).where("__b is not null")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
                                   F.lit(0.0), lambda acc, v: acc + v)
    a, b = F.col("__a"), F.col("__b")
    n = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return (pairs.select(entity_id, tech_id).distinct().join(left, entity_id).join(right, tech_id)
            .select(entity_id, tech_id, F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0)).alias("score")))


def gated_cosine(entities: DataFrame, techs: DataFrame, boosted: DataFrame, entity_id: str, entity_vec: str,
                 tech_id: str, tech_vec: str, low: float) -> DataFrame:
    """Cosines of all pairs that a decision with gate ``low`` can use: those that
    reach ``low`` themselves, and the ``boosted`` pairs (entity_id, tech_id) whatever
    their cosine.  Every other pair stays under the gate."""
    reach = cosine_scores(entities, techs, entity_id, entity_vec, tech_id, tech_vec, min_score=low)
    return (cosine_pairs(boosted, entities, techs, entity_id, entity_vec, tech_id, tech_vec)
            .where(F.col("score") < low).unionByName(reach)
            .groupBy(entity_id, tech_id).agg(F.max("score").alias("score")))


def keyword_overlap(entity_kw: DataFrame, tech_kw: DataFrame, entity_id: str, tech_id: str,
                    kw: str = "keywords") -> DataFrame:
    """(entity, tech) pairs whose keyword arrays share an element, as an
    exploded equi-join (the technology side is size-checked for broadcast)."""
    # a plain explode would make the optimizer filter on the array's size, which forms the keywords twice
    e, t = (x.select(F.col(i), F.explode_outer(F.array_distinct(F.col(kw))).alias("kw")).where("kw is not null")
            for x, i in ((entity_kw, entity_id), (tech_kw, tech_id)))
    return e.join(broadcast_if_small(t), "kw").select(entity_id, tech_id).distinct()
