"""Importance resampling towards a target distribution.

1. Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text with A-Z lower-cased; features are
   all runs of 1 to ``max_n`` consecutive words, joined by one space, repeats counted.  A feature's bucket is
   its crc32 modulo ``buckets``.  Each document's buckets are stored once.
2. Two counts per bucket (documents and target) give an array of ``buckets`` whole-numbered gains: all that the driver
   sees of the corpus.  A document's weight is the floored mean of its features' gains, looked up in that array.
3. The score is the weight plus Gumbel noise from a hash of the id; (id, score) rows are stored.
4. The cutoff is found by numeric bisection: every step is one exact count over the stored scores; ties at the cutoff are
   cut by a second bisection over the id.
5. The drawn rows are range-partitioned by (score, id) and ranked from the partitions' row counts.

Defined results: a null or empty text has no feature and weight 0; a null id hashes as the empty string and comes after
all other ids in a tie; every row of a repeated id takes part by itself, and rows with the same score and id are told apart by
their number of features, then in any order (such rows are equal); ids are whole numbers; an empty table gives an empty
result and an empty target gives gains against zero counts; other columns are ignored unless named in ``columns``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave.llm.common import ascii_lower, materialise

BUCKETS = 10_000
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
# What separates words, on text whose A-Z are lower-cased.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words of a text (an empty array for null)."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def feature_buckets(word_list: Column, max_n: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``max_n`` consecutive words."""
    def bucket(feature: Column) -> Column:
        return (F.crc32(feature.cast("binary")) % buckets).cast("int")

    def runs(n: int) -> Column:
        last = F.size(word_list) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: bucket(F.array_join(F.slice(word_list, i + 1, n), " ")))

    first = F.transform(word_list, bucket)
    return first if max_n == 1 else F.concat(first, *[runs(n) for n in range(2, max_n + 1)])


def _counts(rows: DataFrame, name: str) -> DataFrame:
    """Features per bucket: at most ``buckets`` rows, added up before the shuffle."""
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Gain of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    spark = source.sparkSession
    per = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
           .join(_counts(source, "s"), "bucket", "left").join(_counts(target, "t"), "bucket", "left")
           .na.fill(0, ["s", "t"]).select("bucket", "s", "t").collect())    # ``buckets`` rows, whatever the corpus
    s_all, t_all = sum(r["s"] for r in per), sum(r["t"] for r in per)
    sums = spark.createDataFrame([(r["bucket"], r["s"], r["t"]) for r in per], "bucket int, s long, t long")
    d = lambda c: c.cast("double")
    ratio = d((F.col("t") + 1) * (s_all + buckets)) / d((F.col("s") + 1) * (t_all + buckets))
    out = [0] * buckets
    for r in sums.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("g")).collect():
        out[r["bucket"]] = r["g"]
    return out


def scored(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           target_text: str = "text", max_n: int = 1, buckets: int = BUCKETS, seed: int = SEED,
           columns: Sequence[str] = ()) -> DataFrame:
    """(uid, doc_id, n_words, n_features, weight, score, extra) of every row, stored."""
    extra = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("int")
    src = (documents.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"),
                            words(F.col(text_col)).alias("words"), extra.alias("extra"))
           .select("uid", "doc_id", "extra", F.size("words").cast("long").alias("n_words"),
                   feature_buckets(F.col("words"), max_n, buckets).alias("buckets")))
    src = materialise(src)
    tgt = (target.select(words(F.col(target_text)).alias("words"))
           .select(feature_buckets(F.col("words"), max_n, buckets).alias("buckets")))
    # an array literal of ``buckets`` numbers (folded once by the optimizer)
    table = F.split(F.lit(",".join(map(str, gains(src, tgt, buckets)))), ",").cast("array<bigint>")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda a, b: a + F.get(table, b))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256),
                           1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    n = F.col("n_features")
    return materialise(
        src.withColumn("n_features", F.size("buckets").cast("long")).withColumn("total", total)
        .withColumn("weight", F.when(n == 0, F.lit(0).cast("long")).otherwise(
            F.expr("(total - pmod(total, n_features)) div n_features")))
        .select("uid", "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"), "extra"))


def _smallest(reaches: Callable[[int], bool], lo: int, hi: int) -> int:
    """The smallest whole number in lo..hi with ``reaches`` (true at hi, false below some place)."""
    while lo < hi:
        mid = (lo + hi) // 2
        if reaches(mid):
            hi = mid
        else:
            lo = mid + 1
    return lo


def _drawn(rows: DataFrame, k: int) -> Column:
    """Condition on the k best rows by (score falling, id rising): those above the cutoff, and those tied with it up to an id.

    Rows equal in score and id stand or fall together here, so the condition may hold for a few more.
    """
    def count(cond: Column) -> int:
        return rows.where(cond).count()

    score, ident = F.col("score"), F.col("doc_id")
    ends = rows.agg(F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    # the largest score that k rows reach
    cut = -_smallest(lambda c: count(score >= -c) >= k, -ends["hi"], -ends["lo"])
    need = k - count(score > cut)
    tied = rows.where(score == cut)
    ends = tied.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("doc_id").alias("n")).first()
    if ends["n"] < need:
        return score >= cut
    last = _smallest(lambda d: count((score == cut) & (ident <= d)) >= need, ends["lo"], ends["hi"])
    return (score > cut) | ((score == cut) & F.coalesce(ident <= last, F.lit(False)))


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with ``rank`` 1..k by (score falling, id rising), null below."""
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    if k == 0:
        return none
    spark = rows.sparkSession
    chosen = _drawn(rows, k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("uid")]
    # uid makes the range keys unique: many equal rows don't land in one partition
    placed = materialise(rows.where(chosen).repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    before, base = 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):   # one number per range partition
        base.append((r["part"], before))
        before += r["count"]
    base = F.broadcast(spark.createDataFrame(base, "part long, base long"))
    rank = F.col("base") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    top = (placed.join(base, part == F.col("part")).withColumn("rank", F.when(rank <= k, rank)).select(none.columns))
    return top.unionByName(none.where(~chosen))


def resample(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = 1,
             buckets: int = BUCKETS, seed: int = SEED, columns: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank[, extra]) of every row.

    Of the N rows with at least ``min_words`` words the floor(percent N / 100) best by score get a rank; the others
    have a null one.  ``columns`` are carried in the struct ``extra`` (say, the text of the drawn rows).
    """
    rows = scored(documents, target, id_col, text_col, target_text, max_n, buckets, seed, columns)
    enough = rows.where(F.col("n_words") >= min_words)
    out = ranked(enough, percent * enough.count() // 100).unionByName(
        rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    keep = [F.col("doc_id").alias(id_col), "n_features", "weight", "score", "rank"]
    return out.select(*keep, *(["extra"] if columns else []))
