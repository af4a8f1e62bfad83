"""Packing of token sequences by non-negative least squares.

1. Texts are tokenized once; ids are stored compressed in the shared folder.
2. A document is cut into full windows and one remainder.  Remainders are
   counted in length bins of ``WINDOW / N_BINS`` tokens and ``N_BUCKETS`` buckets: the driver sees
   (``N_BINS`` + 1) x ``N_BUCKETS`` counts at most, whatever the corpus, and adds them up to the histogram.
3. All combinations of at most ``DEPTH`` bins that fill a window are enumerated;
   non-negative least squares gives their repeat counts against the
   histogram; the counts are rounded down to what the histogram holds, then
   left-overs are combined greedily.
4. Spark ranks the remainders inside their bins (numbers from stored bucket counts, no
   group in one task) and looks the rank up in the small plan: that is the sequence.
5. What no combination takes is laid end to end and cut at window borders, so it
   is packed without padding; prefix sums come from bucket sums.

Defined results: a null or empty text is the end id alone; repeated rows and
repeated or null ids are separate documents; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphweave.llm import bpe
from graphweave.llm.common import materialise, spread

WINDOW = 2048
N_BINS = 128
DEPTH = 3
END_ID = 1
N_BUCKETS = 1024


def combinations(n_bins: int = N_BINS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` bins whose sum is ``n_bins``."""
    out: list[tuple[int, ...]] = []

    def grow(prefix: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(prefix)
        elif len(prefix) == depth - 1:
            if left <= prefix[-1]:
                out.append((*prefix, left))
        elif len(prefix) < depth:
            for b in range(min(left, prefix[-1] if prefix else left), 0, -1):
                grow((*prefix, b), left - b)

    if depth == 1:
        return [(n_bins,)]
    grow((), n_bins)
    return out


def nnls(a: np.ndarray, y: np.ndarray, max_rounds: int = 1000) -> np.ndarray:
    """Lawson-Hanson active-set solution of min |a x - y|, x >= 0."""
    n = a.shape[1]
    x = np.zeros(n)
    active = np.zeros(n, dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ y).max(initial=0.0)))
    for _ in range(max_rounds):
        slope = a.T @ (y - a @ x)
        slope[active] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= tol:
            break
        active[j] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], y, rcond=None)[0]
            low = active & (s <= 1e-12)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-300))
            x += min(1.0, step) * (s - x)
            active &= x > 1e-12
            x[~active] = 0.0
            if not active.any():
                break
        x = np.where(active, s, 0.0)
    return x


def plan_counts(hist: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Repeat counts of combinations; ``hist[b - 1]`` remainders have bin ``b``.

    No bin is used more often than the histogram holds it.
    """
    n_bins = len(hist)
    combos = combinations(n_bins, depth)
    total = float(hist.sum())
    if total == 0:
        return []
    a = np.zeros((n_bins, len(combos)))
    for j, c in enumerate(combos):
        for b in c:
            a[b - 1, j] += 1
    x = nnls(a, hist / total) * total
    left = hist.astype(np.int64).copy()
    counts: dict[tuple[int, ...], int] = {}

    def take(c: tuple[int, ...], most: int) -> None:
        most = min([most, *(int(left[b - 1]) // c.count(b) for b in set(c))])
        if most > 0:
            counts[c] = counts.get(c, 0) + most
            for b in c:
                left[b - 1] -= most

    for j in sorted(np.flatnonzero(x > 0).tolist(), key=lambda j: (-x[j], j)):
        take(combos[j], int(np.floor(x[j] + 1e-6)))
    for c in combos:  # greedy: left-overs in order of their longest part
        if left[c[0] - 1] > 0:
            take(c, int(left[c[0] - 1]))
    return sorted(counts.items(), reverse=True)


def tokenize(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """(uid, doc_id, n, width, ids): compressed ids of every document row, stored."""
    # the vocabulary, whatever the number of documents
    held = documents.sparkSession.sparkContext.broadcast(bpe.rank_table(tokenizer_path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        enc = bpe.shared_encoder(tokenizer_path, held.value)
        width = 2 if max(enc.tk.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for lo, hi in bpe.sized_batches(b["text"].tolist()):
                part = b.iloc[lo:hi]
                ids = [np.append(np.frombuffer(x, dtype="<u4"), np.uint32(end_id)).astype(f"<u{width}")
                       for x in enc.encode(part["text"].tolist())]
                yield pd.DataFrame({"uid": part["uid"], "doc_id": part["doc_id"], "n": [len(x) for x in ids],
                                    "width": width, "ids": [z.compress(x.tobytes()) for x in ids]})
    rows = spread(documents.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialise(rows.mapInPandas(run, "uid long, doc_id string, n long, width int, ids binary"))


def _small(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A table whose size is bounded by bins, combinations or buckets: broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def place(lengths: DataFrame, window: int = WINDOW, n_bins: int = N_BINS) -> DataFrame:
    """(uid, start, length, sequence_id, offset) of every piece, from (uid, n)."""
    spark = lengths.sparkSession
    unit = window // n_bins
    rows = materialise(lengths.select(
        "uid", "n", F.floor(F.col("n") / window).cast("long").alias("full"), (F.col("n") % window).alias("rem"))
        .withColumn("bin", F.ceil(F.col("rem") / unit).cast("int"))
        .withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(N_BUCKETS)).cast("int")))
    per = rows.groupBy("bin", "bucket").count().collect()  # at most (N_BINS + 1) * N_BUCKETS rows
    hist = np.zeros(n_bins, dtype=np.int64)
    ahead, base = {}, []
    for r in sorted(per, key=lambda r: (r["bin"], r["bucket"])):
        base.append((r["bin"], r["bucket"], ahead.get(r["bin"], 0)))
        ahead[r["bin"]] = ahead.get(r["bin"], 0) + r["count"]
    for b, c in ahead.items():
        if b > 0:
            hist[b - 1] = c
    used = [0] * (n_bins + 1)
    slots, n_seq = [], 0
    for combo, count in plan_counts(hist):
        for k, b in enumerate(combo):
            slots.append((b, used[b], used[b] + count, n_seq, k))
            used[b] += count
        n_seq += count
    ranked = (rows.withColumn("r", F.row_number().over(Window.partitionBy("bin", "bucket").orderBy("uid")) - 1)
              .join(_small(spark, base, "bin int, bucket int, base long"), ["bin", "bucket"])
              .withColumn("r", F.col("r") + F.col("base")))
    plan = _small(spark, slots, "pbin int, lo long, hi long, seq0 long, part int")
    found = materialise(ranked.join(plan, (F.col("bin") == F.col("pbin")) & (F.col("r") >= F.col("lo"))
                                    & (F.col("r") < F.col("hi")), "left")
                        .select("uid", "bucket", "full", "rem", "part",
                                (F.col("seq0") + F.col("r") - F.col("lo")).alias("seq"))
                        .withColumn("loose", F.when(F.col("seq").isNull(), F.col("rem")).otherwise(F.lit(0))))
    sums = {r["bucket"]: r for r in found.groupBy("bucket").agg(
        F.sum("full").alias("full"), F.sum("loose").alias("loose")).collect()}
    order = sorted(sums)
    full0 = [0, *accumulate(sums[b]["full"] for b in order)]
    loose0 = [0, *accumulate(sums[b]["loose"] for b in order)]
    first_full = n_seq + -(-loose0[-1] // window)
    before = _small(spark, [(b, full0[i], loose0[i]) for i, b in enumerate(order)],
                    "bucket int, full0 long, loose0 long")
    prior = Window.partitionBy("bucket").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    at = (found.where("full > 0 or loose > 0")
          .withColumns({"f": F.coalesce(F.sum("full").over(prior), F.lit(0)),
                        "p": F.coalesce(F.sum("loose").over(prior), F.lit(0))})
          .join(before, "bucket")
          .withColumns({"f": F.col("f") + F.col("full0") + first_full, "p": F.col("p") + F.col("loose0")}))
    i = F.col("i")
    whole = (at.where("full > 0").select("uid", "f", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("i"))
             .select("uid", (i * window).alias("start"), F.lit(window).cast("long").alias("length"),
                     (F.col("f") + i).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    lo = F.greatest(F.col("p"), i * window)
    hi = F.least(F.col("p") + F.col("rem"), (i + 1) * window)
    cut = (at.where("loose > 0")
           .select("uid", "full", "rem", "p", F.explode(F.sequence(
               F.floor(F.col("p") / window), F.floor((F.col("p") + F.col("rem") - 1) / window))).alias("i"))
           .select("uid", (F.col("full") * window + lo - F.col("p")).alias("start"), (hi - lo).alias("length"),
                   (i + n_seq).alias("sequence_id"), (lo - i * window).alias("offset")))
    mates = Window.partitionBy("sequence_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    combined = (found.where("seq is not null")
                .select("uid", (F.col("full") * window).alias("start"), F.col("rem").alias("length"),
                        F.col("seq").alias("sequence_id"), "part")
                .withColumn("offset", F.coalesce(F.sum("length").over(mates), F.lit(0))).drop("part"))
    return whole.unionByName(cut).unionByName(combined)


def attach(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """Ids of every piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit.  Each document's ids move once,
    whatever the number of its pieces.
    """
    per_doc = pieces.groupBy("uid").agg(F.sort_array(F.collect_list(
        F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    joined = tokens.join(per_doc, "uid").select("doc_id", "n", "width", "ids", "pieces")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for at in range(0, len(b), 128):
                out = []
                for doc_id, n, width, ids, pieces in b.iloc[at:at + 128].itertuples(index=False):
                    raw = np.frombuffer(z.decompress(ids), dtype=f"<u{width}").astype("<u4")
                    for p in pieces:
                        s, m = p["start"], p["length"]
                        out.append((doc_id, s, m, raw[s:s + m].tobytes(), n, p["sequence_id"], p["offset"]))
                yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens",
                                                 "sequence_id", "offset"])
    return joined.mapInPandas(run, "doc_id string, start long, length long, ids binary, doc_tokens long, "
                                   "sequence_id long, offset long")


def pack(documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids and places (see ``attach``)."""
    tokens = tokenize(documents, tokenizer_path, id_col, text_col, end_id)
    out = attach(place(tokens.select("uid", "n"), window), tokens)
    return out.withColumn("doc_id", F.col("doc_id").cast(documents.schema[id_col].dataType))
