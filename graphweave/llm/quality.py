"""Quality rules with adaptive thresholds.

Two base rules are fixed: a minimum of words and a maximum share of words in
repeated 8-word windows.  The other rules compare a document with what is usual
for its language and source: symbols and exclamation marks per word, words that
repeat the word before them, repeated lines per line, and the mean word length
(both ends).

Thresholds come from mergeable quantile sketches: counts of values in
log-linear integer buckets (exact below 64, then 32 buckets per power of two, so
a relative error under 1/32).  Sketches are summed per (language, source),
merged per language and over all.  The fence of a sketch is
``median + SPREAD * max(interquartile range, least spread)``.  A group of n documents weighs its own fence by n and that
of its language by ``WEIGHT``, and the language the one of all in the same way, so few documents lean on the wider
sketch and no verdict turns on one more document.  A threshold, and the wider fence it leans on, is at most
``CEILING`` times the median of the groups' own fences, each group having one vote, so that a source made of junk
cannot excuse itself however many rows it has (unless half of all groups are junk).

Everything is DataFrame expressions; the per-document numbers are computed once
and stored, the sketches have a bounded number of rows per group, and the thresholds
are joined on (language, source).

Defined results: a null text has no words (base rule fails); null languages and
sources are groups of their own; repeated rows count each; an empty table
gives an empty result; other columns pass through ``filter_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphweave.llm.common import WS, as_row, from_row, materialise, text_key

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WEIGHT = 200
SPREAD = 4
CEILING = 2
# Least spread of each rule, in the rule's own unit (see ``rules``).
LEAST_SPREAD = {"symbols": 20, "dup_lines": 100, "length": 50, "bangs": 20, "stutter": 25}


def _flat(text: Column) -> Column:
    out = text
    for c in WS[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def _symbols(text: Column) -> Column:
    total = F.lit(0)
    for c in SYMBOLS:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return total


def _at(array: str, index: Column) -> Column:
    return F.get(F.col(array), index)


def document_numbers(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """The input columns and the counts that the rules use.

    Arrays that later expressions read more than once are columns of their own
    projection, so each is computed once per row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")
    first = documents.withColumns({
        "_flat": _flat(text), "_lines": lines,
        "n_symbols": _symbols(text).cast("long"),
        "n_bangs": (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("!"), F.lit("")))).cast("long")})
    second = first.withColumns({
        "_words": F.transform(F.array_remove(F.split("_flat", " ", -1), ""), lambda w: F.xxhash64(w)),
        "word_chars": F.char_length(F.replace(F.col("_flat"), F.lit(" "), F.lit(""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")})
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    third = second.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_stutter": F.size(F.filter(F.col("_words"), lambda w, i: F.when(i > 0, _at("_words", i - 1) == w).otherwise(
            F.lit(False)))).cast("long"),
        "_win": F.transform(starts, lambda i: F.xxhash64(*[_at("_words", i + k) for k in range(WINDOW)]))})
    fourth = third.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda s, k: _at("_sorted", k)["h"] == s["h"]
    fifth = fourth.withColumn("_again", F.sort_array(F.transform(
        F.filter(F.col("_sorted"), lambda s, k: F.coalesce(
            F.when(k > 0, same(s, k - 1)), F.lit(False)) | F.coalesce(same(s, k + 1), F.lit(False))),
        lambda s: s["i"])))
    covered = F.aggregate(
        F.transform(F.col("_again"), lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(_at("_again", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return fifth.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_flat", "_lines", "_words", "_win", "_sorted", "_again")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Value of each adaptive rule: symbols, exclamation marks and words equal to the
    word before per 1,000 words, repeated lines per 1,000 lines, characters per 100 words."""
    return {"symbols": F.expr("1000 * n_symbols div greatest(n_words, 1L)"),
            "dup_lines": F.expr("1000 * n_dup_lines div greatest(n_lines, 1L)"),
            "length": F.expr("100 * word_chars div greatest(n_words, 1L)"),
            "bangs": F.expr("1000 * n_bangs div greatest(n_words, 1L)"),
            "stutter": F.expr("1000 * n_stutter div greatest(n_words, 1L)")}


# Lower end of the bucket of a value v (v >= 0): v itself below 64, else its six leading bits.
BUCKET = "CASE WHEN v < 64 THEN v ELSE shiftleft(shiftright(v, length(bin(v)) - 6), length(bin(v)) - 6) END"


def sketches(numbers: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, rule, bucket, c): one sketch per group; sketches merge by summing ``c``."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("v")) for k, v in rules().items()]))
    return (numbers.where(~base_failed())
            .select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), each.alias("e"))
            .select("lang", "source", "e.rule", "e.v").withColumn("bucket", F.expr(BUCKET))
            .groupBy("lang", "source", "rule", "bucket").agg(F.count(F.lit(1)).alias("c")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("c").alias("c"))
    whole = Window.partitionBy(*keys, "rule")
    cum = merged.withColumns({"n": F.sum("c").over(whole), "cum": F.sum("c").over(whole.orderBy("bucket"))})
    at = lambda q: F.min(F.when(100 * F.col("cum") >= q * F.col("n"), F.col("bucket")))
    return cum.groupBy(*keys, "rule").agg(F.max("n").alias("n"), at(25).alias("q1"), at(50).alias("q2"),
                                          at(75).alias("q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, max_symbols, max_dup_lines, max_length, min_length, max_bangs, max_stutter) of every group."""
    least = F.create_map(*[F.lit(x) for kv in LEAST_SPREAD.items() for x in kv])[F.col("rule")]
    spread = SPREAD * F.greatest(F.col("q3") - F.col("q1"), least)

    def limits(q: DataFrame, tag: str) -> DataFrame:
        keep = [c for c in ("lang", "source") if c in q.columns]
        return q.select(*[F.col(c).alias(f"{tag}_{c}") for c in keep], F.col("rule").alias(f"{tag}_rule"),
                        F.col("n").alias(f"{tag}_n"), (F.col("q2") + spread).alias(f"{tag}_hi"),
                        F.greatest(F.col("q2") - spread, F.lit(0)).alias(f"{tag}_lo"))

    g = limits(_quartiles(sketch, ["lang", "source"]), "g")
    by_lang = limits(_quartiles(sketch, ["lang"]), "l")
    over_all = limits(_quartiles(sketch, []), "a")
    votes = g.groupBy("g_rule").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY g_hi)").cast("long").alias("median")).select(
        F.col("g_rule").alias("m_rule"), "median")
    joined = (g.join(by_lang, F.col("g_lang").eqNullSafe(F.col("l_lang")) & (F.col("g_rule") == F.col("l_rule")))
              .join(F.broadcast(over_all), F.col("g_rule") == F.col("a_rule"))  # one row per rule
              .join(F.broadcast(votes), F.col("g_rule") == F.col("m_rule")))

    def blended(e: str, cap: Column | None = None) -> Column:
        mix = lambda n, own, wider: F.floor((n * own + WEIGHT * wider) / (n + WEIGHT))
        wider = mix(F.col("l_n"), F.col(f"l_{e}"), F.col(f"a_{e}"))
        if cap is None:
            return mix(F.col("g_n"), F.col(f"g_{e}"), wider)
        return F.least(mix(F.col("g_n"), F.col(f"g_{e}"), F.least(wider, cap)), cap)

    chosen = joined.select(F.col("g_lang").alias("lang"), F.col("g_source").alias("source"),
                           F.col("g_rule").alias("rule"),
                           blended("hi", CEILING * F.col("median")).alias("hi"), blended("lo").alias("lo"))
    of = lambda r, e: F.max(F.when(F.col("rule") == r, F.col(e)))
    return chosen.groupBy("lang", "source").agg(
        of("symbols", "hi").alias("max_symbols"), of("dup_lines", "hi").alias("max_dup_lines"),
        of("length", "hi").alias("max_length"), of("length", "lo").alias("min_length"),
        of("bangs", "hi").alias("max_bangs"), of("stutter", "hi").alias("max_stutter"))


def judge(numbers: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``numbers`` with ``base_failed`` and ``kept``."""
    t = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    v = rules()
    good = ((v["symbols"] <= F.col("max_symbols")) & (v["dup_lines"] <= F.col("max_dup_lines"))
            & (v["length"] <= F.col("max_length")) & (v["length"] >= F.col("min_length"))
            & (v["bangs"] <= F.col("max_bangs")) & (v["stutter"] <= F.col("max_stutter")))
    return (numbers.join(t, F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source")),
                         "left")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(good, F.lit(False))).drop("_lang", "_source"))


def verdicts(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             id_cols: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts, thresholds, ``base_failed`` and ``kept`` of every row, with the row's text key."""
    t1, t2 = text_key(F.col(text_col))
    narrow = documents.select(*id_cols, F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                              F.col(text_col).alias("_text"), t1.alias("_t1"), t2.alias("_t2"))
    numbers = materialise(document_numbers(narrow, "_text").drop("_text"))
    limits = materialise(thresholds(materialise(sketches(numbers))))
    return judge(numbers, limits)


def filter_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """The rows that pass, with all their columns."""
    kept = verdicts(documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                                     F.col(source_col).alias("source")), id_cols=("_id",)).where("kept").select(
        "_id", "_t1", "_t2", F.col("lang").alias("_l"), F.col("source").alias("_s"))
    row = F.col("_row")
    k1, k2 = text_key(row[text_col])
    out = as_row(documents).withColumns({"_k1": k1, "_k2": k2}).join(
        kept, row[id_col].eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_t1"))
        & (F.col("_k2") == F.col("_t2")) & row[lang_col].eqNullSafe(F.col("_l"))
        & row[source_col].eqNullSafe(F.col("_s")), "left_semi")
    return from_row(out, documents.columns)
