"""Exact and fuzzy de-duplication.

* ``keep_first``          — exact dedupe on a key, first row (by an order column) wins.
* ``similar_strings``     — all pairs of distinct strings whose Indel ratio reaches a
                            threshold, by a rare-gram prefix join with exact filters.
* ``similar_between``     — the same between the strings of two tables.
* ``similar_pairs``       — the same between rows.
* ``greedy_fuzzy_dedupe`` — the sequential "drop a row similar to an already kept
                            earlier row" scan, computed as rounds over the pair graph.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import lcs_at_least_udf, ratio_from_lcs, with_lcs
from ..functions.text import token_sort
from .common import fits_broadcast, seq, stored


def with_position(df: DataFrame, out: str = "row_pos") -> DataFrame:
    """Add the position of every row in reading order and store the table, so that
    the numbers stay the same for all later steps."""
    return stored(df.withColumn(out, F.monotonically_increasing_id()))


def keep_first(df: DataFrame, key, order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order`` value.

    The key is reduced to a SHA-256 digest before the shuffle and the minimum is
    taken with a partial (map-side) aggregate, so a key that holds a third of
    all rows costs one row per map task, not one huge group.  Rows that also tie
    on ``order`` (repeated ids) give one row, the one with the smallest row hash.
    """
    k = F.sha2(key if not isinstance(key, str) else F.col(key), 256)
    rows = df.withColumns({"__k": k, "__h": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])})
    firsts = rows.groupBy("__k").agg(F.min(F.struct(F.col(order), F.col("__h"))).alias("m")).select(
        F.col("__k").alias("__k2"), F.col(f"m.{order}").alias("__o"), F.col("m.__h").alias("__h2"))
    same = (F.col("__k").eqNullSafe(F.col("__k2")) & F.col(order).eqNullSafe(F.col("__o")) & (F.col("__h") == F.col("__h2")))
    return rows.join(firsts, same, "left_semi").dropDuplicates(["__k"]).drop("__k", "__h")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def merge_edges(new_edges: DataFrame, existing: DataFrame | None, src: str, dst: str) -> DataFrame:
    """Idempotent edge creation: one edge per (src, dst), none that already exists."""
    e = new_edges.dropDuplicates([src, dst])
    if existing is not None:
        e = e.join(existing.select(src, dst), [src, dst], "left_anti")
    return e


# ------------------------------------------------------------------ pair search
def _needed(total, t: int, q: int):
    """Common q-grams that a pair of summed length ``total`` must have at least.

    A deletion destroys at most q grams and an insertion q - 1; with an LCS of
    length L >= t * total / 200 that leaves (2q - 1) L - (q - 1) (total + 1).
    """
    low = F.ceil(F.lit(t) * total / F.lit(200.0)) if isinstance(total, Column) else math.ceil(t * total / 200)
    return (2 * q - 1) * low - (q - 1) * (total + 1)


def _least_needed(total: Column, t: int, q: int) -> Column:
    """The least ``_needed`` of all pairs whose summed length is at least ``total``.

    With its length rounded up, ``_needed`` falls by q - 1 where a longer pair needs no longer LCS; without rounding it only rises.
    """
    return F.ceil((F.lit((2 * q - 1) * t) * total - F.lit(200 * (q - 1)) * (total + 1)) / F.lit(200.0))


def _grams(s: Column, q: int) -> Column:
    """Distinct (gram, occurrence) texts of a string, sorted: a multiset as a set."""
    raw = F.sort_array(F.transform(seq(F.lit(1), F.length(s) - (q - 1)), lambda i: F.substr(s, i, F.lit(q))))
    return raw


def _numbered(col: str) -> Column:
    """Sorted grams -> gram plus the number of its repetition."""
    g = F.col(col)
    return F.transform(g, lambda x, i: F.concat_ws("\u0001", x, (i + 1 - F.array_position(g, x)).cast("string")))


def _route(base: DataFrame, t: int, q: int, admit) -> DataFrame:
    """(ua, ub) candidates whose summed length ``admit`` takes, by gram prefixes.

    The grams of a string are ordered by how rare they are; two strings with c
    common grams share one of the first ``size - c + 1`` of each.
    """
    g = f"g{q}"
    each = base.select("u", "l", F.size(g).alias("n"), F.explode(g).alias("gram"))
    rare = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    least_partner = F.ceil(F.lit(t) * F.col("l") / F.lit(200.0 - t))
    prefix = F.col("n") - F.greatest(_least_needed(F.col("l") + least_partner, t, q), F.lit(1)) + 1
    heads = (each.join(rare, "gram").groupBy("u", "l", "n")
             .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("x"))
             .select("u", "l", F.explode(F.slice(F.col("x"), F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("h"))
             .select("u", "l", F.col("h.gram").alias("gram")))
    heads = stored(heads)
    a, b = (heads.select(F.col("u").alias(f"u{x}"), F.col("l").alias(f"l{x}"), "gram") for x in "ab")
    band = (F.lit(200 - t) * F.least("la", "lb") >= F.lit(t) * F.greatest("la", "lb"))
    return (a.join(b, "gram").where((F.col("ua") < F.col("ub")) & band & admit(F.col("la") + F.col("lb")))
            .select("ua", "ub").distinct())


def similar_strings(strings: DataFrame, col: str, threshold: int) -> DataFrame:
    """Pairs ``(sa, sb, ratio)``, ``sa < sb``, of distinct non-empty strings with
    Indel ratio >= ``threshold`` (any threshold above 0).

    Candidates share a rare gram (``_route``): character pairs where the length
    guarantees common pairs, single characters for shorter strings and low thresholds.
    They must pass the length band, the exact count of common grams and of
    common characters; only then the LCS is computed.  No pair is lost.
    """
    t = threshold
    if not 0 < t <= 100:
        raise ValueError("threshold must be in (0, 100]")
    distinct = strings.select(F.col(col).alias("s")).where("s <> ''").distinct()
    base = distinct.withColumns({"u": F.monotonically_increasing_id(), "l": F.length("s"),
                                 "r1": _grams(F.col("s"), 1), "r2": _grams(F.col("s"), 2)})
    base = stored(base.select("u", "s", "l", _numbered("r1").alias("g1"), _numbered("r2").alias("g2")))
    slope = 3 * t / 200 - 1
    cut = math.ceil(2 / slope) + 2 if slope > 0.05 else None  # pairs at least this long together share two-grams
    if cut is None:
        cand = _route(base, t, 1, lambda n: F.lit(True))
    else:
        cand = _route(base.where(F.col("l") < cut), t, 1, lambda n: n < cut).unionByName(
            _route(base, t, 2, lambda n: n >= cut))
    side = lambda x: base.select(*[F.col(c).alias(f"{c}{x}") for c in ("u", "s", "l", "g1", "g2")])
    total = F.col("la") + F.col("lb")
    shared = lambda q: F.size(F.array_intersect(f"g{q}a", f"g{q}b")) >= _needed(total, t, q)
    pairs = (cand.join(side("a"), "ua").join(side("b"), "ub").where(shared(2)).where(shared(1))
             .select(F.least("sa", "sb").alias("sa"), F.greatest("sa", "sb").alias("sb")))
    return (with_lcs(pairs, "sa", "sb", "lcs")
            .where(F.lit(200) * F.col("lcs") >= F.lit(t) * (F.length("sa") + F.length("sb")))
            .select("sa", "sb", ratio_from_lcs(F.col("lcs"), F.length("sa"), F.length("sb")).alias("ratio")))


SALT = 32


def similar_between(left: DataFrame, left_col: str, right: DataFrame, right_col: str, threshold: int) -> DataFrame:
    """Pairs ``(sa, sb, ratio)`` of a distinct string of ``left`` and one of ``right`` (equal ones too) with Indel ratio >=
    ``threshold``; two empty strings have ratio 100.

    Strings whose lengths admit the ratio lie in the same or neighbouring classes of a geometric series, which
    is the join key.  The right side is broadcast when its size check passes; beyond it both
    sides meet by shuffle and each class is dealt over salts.  What meets must pass the length band and the exact count of common
    characters; only then the LCS is computed.
    """
    t = threshold
    if not 0 < t < 100:
        raise ValueError("threshold must be between 0 and 100")

    def base(df: DataFrame, col: str, x: str) -> DataFrame:
        s = df.select(F.col(col).alias("s")).where("s is not null").distinct().withColumn("l", F.length("s"))
        band = F.when(F.col("l") == 0, -2).otherwise(F.floor(F.log("l") / math.log((200 - t) / t) + 1e-9)).cast("int")
        return s.select(F.col("s").alias(f"s{x}"), F.col("l").alias(f"l{x}"), band.alias(f"k{x}"))

    b = base(right, right_col, "b")
    b = stored(b.withColumn("kb", F.explode(F.when(F.col("kb") == -2, F.array("kb")).otherwise(
        F.array(F.col("kb") - 1, F.col("kb"), F.col("kb") + 1)))))
    a = base(left, left_col, "a")
    # strings without a partner of a fitting length go before anything is computed for them
    a = a.join(F.broadcast(b.select(F.col("kb").alias("ka")).distinct()), "ka", "left_semi")
    key = F.col("ka") == F.col("kb")
    if fits_broadcast(b):
        b = F.broadcast(b)
    else:
        a = a.withColumn("xa", F.pmod(F.xxhash64("sa"), F.lit(SALT)).cast("int"))
        b = b.withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        key = key & (F.col("xa") == F.col("xb"))
    band = F.lit(200 - t) * F.least("la", "lb") >= F.lit(t) * F.greatest("la", "lb")
    pairs = a.join(b, key & band).select("sa", "sb")
    scored = pairs.withColumn("lcs", lcs_at_least_udf(t)(F.col("sa"), F.col("sb")))
    return (scored.where("lcs >= 0")
            .select("sa", "sb", ratio_from_lcs(F.col("lcs"), F.length("sa"), F.length("sb")).alias("ratio")))


def similar_pairs(df: DataFrame, id_col: str, text_col: str, threshold: int,
                  sort_tokens: bool = True) -> DataFrame:
    """Pairs ``(id_a, id_b, ratio)`` with ``id_a < id_b`` and Indel ratio >= threshold.

    The ratio is taken on the token-sorted strings when ``sort_tokens``; equal
    strings are collapsed for the search and paired again at the end.  Empty
    strings never match.
    """
    s_expr = token_sort(text_col) if sort_tokens else F.col(text_col)
    base = df.select(F.col(id_col).alias("id"), s_expr.alias("s")).where("s <> ''")
    found = similar_strings(base, "s", threshold)
    a, b = (base.select(F.col("id").alias(f"i{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    between = found.join(a, "sa").join(b, "sb").select("ia", "ib", "ratio")
    equal = a.join(b, F.col("sa") == F.col("sb")).where("ia < ib").select("ia", "ib", F.lit(100.0).alias("ratio"))
    return (between.where("ia <> ib").unionByName(equal)
            .select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"), "ratio").distinct())


# ---------------------------------------------------------------- greedy dedupe
def greedy_fuzzy_dedupe(df: DataFrame, id_col: str, order_col: str, text_col: str, threshold: int,
                        sort_tokens: bool = True) -> DataFrame:
    """Rows kept by the sequential scan "drop a row whose ratio to any already
    kept earlier row is >= threshold" (earlier = smaller ``order_col``).

    Not connected components: with a~b, b~c and a!~c the scan keeps a and c.
    Of rows with equal strings only the first can be kept (whatever drops the
    first drops the others), so the search runs on distinct strings; rows with
    an empty string match nothing and stay.  Rounds over the similarity edges
    (earlier -> later): a string is kept once every earlier neighbour is dropped, and
    dropped once some earlier neighbour is kept; at least the earliest undecided
    string is decided in each round.  Every round is stored in the shared folder.
    ``id_col`` need not be unique.
    """
    s_expr = token_sort(text_col) if sort_tokens else F.col(text_col)
    rows = df.withColumn("__s", F.coalesce(s_expr, F.lit("")))
    first = stored(keep_first(rows.where("__s <> ''"), "__s", order_col))
    pos = first.select(F.col("__s").alias("s"), F.col(order_col).alias("pos"))
    found = similar_strings(pos, "s", threshold)
    at = lambda x: pos.select(F.col("s").alias(f"s{x}"), F.struct("pos", "s").alias(f"p{x}"))
    e = stored(found.join(at("a"), "sa").join(at("b"), "sb").select(
        F.least("pa", "pb")["s"].alias("src"), F.greatest("pa", "pb")["s"].alias("dst")))
    # 0 undecided, 1 kept, 2 dropped; only strings that are an edge target start undecided
    targets = e.select(F.col("dst").alias("s")).distinct().withColumn("st", F.lit(0))
    sources = e.select(F.col("src").alias("s")).distinct().join(targets, "s", "left_anti").withColumn("st", F.lit(1))
    status = stored(targets.unionByName(sources))
    while not status.where("st = 0").isEmpty():
        nb = (e.join(status.where("st = 0").select(F.col("s").alias("dst")), "dst")
              .join(status.select(F.col("s").alias("src"), F.col("st").alias("s_src")), "src")
              .groupBy("dst").agg(F.max((F.col("s_src") == 1).cast("int")).alias("any_kept"),
                                  F.min((F.col("s_src") == 2).cast("int")).alias("all_dropped")))
        status = stored(status.join(nb.withColumnRenamed("dst", "s"), "s", "left")
                        .select("s", F.when(F.col("st") != 0, F.col("st"))
                                .when(F.col("any_kept") == 1, F.lit(2))
                                .when(F.col("all_dropped") == 1, F.lit(1))
                                .otherwise(F.lit(0)).alias("st")))
    dropped = status.where("st = 2").select(F.col("s").alias("__s"))
    kept = first.join(dropped, "__s", "left_anti").drop("__s").select(*df.columns)
    return kept.unionByName(rows.where("__s = ''").select(*df.columns))
