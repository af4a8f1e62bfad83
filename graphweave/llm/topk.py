"""Exact top-k inner-product search by distributed histogram selection.

Queries and candidates are stored as blocks of vectors.  Every pass scores all
block pairs (one matrix product each) and counts, per query, the scores in the bins
of the query's present score range; Spark sums the counts and picks the bin
that holds the k-th highest score, which is the range of the next pass.  When
bins are one score wide the k-th value is known exactly; a last pass returns the
scores at or above it, ties go to the smaller id.

A block reports bins from the top only until it has seen k scores itself (the
global k-th score cannot be lower), and at most k rows of the last pass (ties
beyond that can never be among the k smallest ids).  Both are exact.

Vectors become ``floor(SCALE * x)``; products are exact (double precision below
2^53, Python integers above).

Defined results: null ids, null vectors and vectors with null or non-finite components,
or so long that a score could leave the range of a long, take no part; a
repeated id counts once, with its smallest vector; vectors of different
dimension are not compared; fewer than k candidates give them all; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphweave.llm.common import materialise

SCALE = 64
Q_BLOCK = 2048
C_BLOCK = 4096
BINS = 256
_CHUNK = 256


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, dim, v array<long>, norm2 double) of the vectors that take part."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    scaled = (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(~bad)
              .select(F.col(id_col).cast("long").alias("id"),
                      F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")).alias("d")))
    norm2 = F.aggregate("d", F.lit(0.0), lambda a, x: a + x * x)
    return (scaled.withColumn("norm2", norm2).where(F.col("norm2") <= float(2 ** 62))
            .select("id", F.col("d").cast("array<long>").alias("v"), "norm2")
            .groupBy("id").agg(F.min(F.struct("v", "norm2")).alias("s"))
            .select("id", F.size("s.v").alias("dim"), F.col("s.v").alias("v"), F.col("s.norm2").alias("norm2")))


def _blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    """(dim, <name>, ids, mat): about ``n`` blocks, one row each."""
    def pack(block: pd.DataFrame) -> pd.DataFrame:
        mat = np.array(block["v"].tolist(), dtype="<i8")
        return pd.DataFrame({"dim": [int(block["dim"].iloc[0])], name: [int(block[name].iloc[0])],
                             "ids": [block["id"].to_numpy("<i8").tobytes()], "mat": [mat.tobytes()]})
    dealt = rows.select("id", "dim", "v", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(name))
    return dealt.groupBy("dim", name).applyInPandas(pack, f"dim int, {name} int, ids binary, mat binary")


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all rows of ``b``."""
    fa, fb = a.astype(np.float64), b.astype(np.float64)
    top = math.sqrt((fa * fa).sum(axis=1).max(initial=0.0)) * math.sqrt((fb * fb).sum(axis=1).max(initial=0.0))
    if top < 2 ** 52:
        return (fa @ fb.T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def _scores(q: pd.DataFrame, c: pd.DataFrame):
    """Per chunk of queries: (query ids, present lows, candidate ids, scores, own)."""
    q, c = q.iloc[0], c.iloc[0]
    dim = int(q["dim"])
    q_ids, c_ids = np.frombuffer(q["ids"], "<i8"), np.frombuffer(c["ids"], "<i8")
    q_mat = np.frombuffer(q["mat"], "<i8").reshape(-1, dim)
    c_mat = np.frombuffer(c["mat"], "<i8").reshape(-1, dim)
    low = {s["query_id"]: s["lo"] for s in q["state"]}
    live = np.array([i for i, x in enumerate(q_ids) if int(x) in low], dtype=np.int64)
    for at in range(0, len(live), _CHUNK):
        rows = live[at:at + _CHUNK]
        ids = q_ids[rows]
        lo = np.array([low[int(x)] for x in ids], dtype=np.int64)
        yield ids, lo, c_ids, _product(q_mat[rows], c_mat), ids[:, None] == c_ids[None, :]


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of every query."""
    rows = materialise(quantised(vectors, id_col, vec_col, scale))
    ids = vectors.where(is_query).select(F.col(id_col).cast("long").alias("id")).distinct()
    queries = materialise(rows.join(ids, "id", "left_semi"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("m")).first()
    qsize = queries.agg(F.count(F.lit(1)).alias("n"), F.max("norm2").alias("m")).first()
    nc, nq = max(1, -(-size["n"] // C_BLOCK)), max(1, -(-qsize["n"] // Q_BLOCK))
    cand = materialise(_blocks(rows, nc, "cb"))
    asked = materialise(_blocks(queries, nq, "qb"))
    bound = int(math.sqrt((size["m"] or 0.0) * (qsize["m"] or 0.0))) + 2
    passes = max(1, math.ceil(math.log(2 * bound + 1) / math.log(BINS)))
    while BINS ** passes < 2 * bound + 1:
        passes += 1
    all_c = cand.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    def pairs(state: DataFrame):
        per_block = (state.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(nq)).cast("int"))
                     .groupBy("dim", "qb").agg(F.collect_list(F.struct("query_id", "lo")).alias("state")))
        left = asked.join(per_block, ["dim", "qb"]).withColumn(
            "cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
        return left.groupBy("dim", "qb", "cb").cogroup(all_c.groupBy("dim", "qb", "cb"))

    state = queries.select(F.col("id").alias("query_id"), "dim", F.lit(-bound).cast("long").alias("lo"),
                           F.lit(0).cast("long").alias("above"))
    for p in range(passes - 1, -1, -1):
        width = BINS ** p

        def count(q: pd.DataFrame, c: pd.DataFrame, *, width: int = width) -> pd.DataFrame:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            if len(q) and len(c):
                for ids, lo, _, score, own in _scores(q, c):
                    at = (score - lo[:, None]) // width
                    at[own | (at >= BINS)] = -1
                    at = np.maximum(at, -1) + 1 + (np.arange(len(ids)) * (BINS + 1))[:, None]
                    hist = np.bincount(at.ravel(), minlength=len(ids) * (BINS + 1)).reshape(len(ids), -1)[:, 1:]
                    from_top = np.cumsum(hist[:, ::-1], axis=1)[:, ::-1]
                    r, b = np.nonzero((hist > 0) & (from_top - hist < k))
                    out.append((ids[r], b, hist[r, b]))
            cols = [np.concatenate(x) if out else np.empty(0, dtype=np.int64) for x in (zip(*out) if out else [()] * 3)]
            return pd.DataFrame(dict(zip(("query_id", "bin", "c"), cols, strict=True)))

        hist = (pairs(state).applyInPandas(count, "query_id long, bin long, c long")
                .groupBy("query_id", "bin").agg(F.sum("c").alias("c")))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        cum = hist.withColumn("cum", F.sum("c").over(down)).join(state, "query_id")
        hit = F.col("above") + F.col("cum") >= k
        # the highest bin that reaches k; with fewer than k scores, the lowest bin there is
        chosen = cum.groupBy("query_id", "dim").agg(
            F.max(F.when(hit, F.struct("bin", (F.col("lo") + F.col("bin") * width).alias("lo"),
                                       (F.col("above") + F.col("cum") - F.col("c")).alias("above")))).alias("s"),
            F.min(F.struct("bin", (F.col("lo") + F.col("bin") * width).alias("lo"),
                           (F.col("above") + F.col("cum") - F.col("c")).alias("above"))).alias("t"))
        best = F.coalesce("s", "t")
        state = materialise(chosen.select("query_id", "dim", best["lo"].alias("lo"), best["above"].alias("above")))

    def keep(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(q) and len(c):
            for ids, lo, c_ids, score, own in _scores(q, c):
                r, j = np.nonzero((score >= lo[:, None]) & ~own)
                s, v = score[r, j], c_ids[j]
                order = np.lexsort((v, -s, r))
                r, s, v = r[order], s[order], v[order]
                nth = np.arange(len(r)) - np.searchsorted(r, r)
                ok = nth < k
                out.append((ids[r[ok]], v[ok], s[ok]))
        cols = [np.concatenate(x) if out else np.empty(0, dtype=np.int64) for x in (zip(*out) if out else [()] * 3)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols, strict=True)))

    found = pairs(state).applyInPandas(keep, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
