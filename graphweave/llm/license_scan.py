"""Licence scan: Dice coefficient of word bigrams against licence templates.

Texts are normalised (A-Z lower-cased; ASCII punctuation, control characters and
typographic quotes and dashes become spaces).  The units that are compared are
every line, every paragraph of two or more lines (between blank lines), and the
whole text if it has two or more paragraphs.  Notices that no such unit shows (several
paragraphs inside a longer text, part of a line or paragraph) are found as windows of
words (see ``windows``), of which the best that don't overlap are kept (``choose_windows``).  A unit of ``w``
words has ``w - 1`` bigrams (with repetitions); Dice is ``2 * shared / (unit + template)``.

A Dice of at least t needs sizes within t / (2 - t) of each other.  So a text must share a least number of different bigrams with
a template for any of its units or windows to reach the threshold (``candidates``); only those texts are taken apart, once
per different text.  Among their units those that no template's size admits are dropped before any bigram is formed, and a
pair is joined only if its sizes admit it.  Repetitions are numbered, which makes the
multiset intersection an equi-join of (bigram, number).

Only the templates (a fixed list or the caller's, checked against
``MAX_TEMPLATE_BIGRAMS`` in total) are broadcast.

Defined results: null and empty texts have no units; repeated rows are scanned
together with their id's other rows only if id and text are equal (one result);
ties between templates go to the smaller template id, between windows to the longer one, then the smaller template
id, then the earlier one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphweave.functions.stopwords import ENGLISH
from graphweave.llm.common import ascii_lower, materialise, text_key
from graphweave.llm.licence_texts import TEMPLATES
from graphweave.operators.common import broadcast_if_small

MIN_PERCENT = 80
MAX_TEMPLATE_BIGRAMS = 1_000_000
# What separates words (the line feed is kept for lines).
GAP = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F©–—‘’“”]+"


def normalised_lines(text: Column) -> Column:
    """Lines of words separated by single spaces."""
    flat = F.regexp_replace(ascii_lower(text), GAP, " ")
    return F.transform(F.split(flat, "\n", -1), lambda x: F.trim(x))


def _n_words(line: Column) -> Column:
    return F.when(line == "", 0).otherwise(F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def units(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, kind, first_line, last_line, words, text): lines, paragraphs and whole texts."""
    t1, t2 = text_key(F.col(text_col))
    rows = documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), t1.alias("t1"), t2.alias("t2"),
        normalised_lines(F.col(text_col)).alias("lines"))
    # each array is used twice or more by the next projection, so it stays a column of its own
    rows = rows.withColumns({
        "counts": F.transform("lines", _n_words),
        "blanks": F.filter(F.sequence(F.lit(-1), F.size("lines")),
                           lambda i: (i == -1) | (i == F.size("lines")) | (F.get(F.col("lines"), i) == ""))})
    paragraphs = F.filter(F.transform("blanks", lambda b, k: F.struct(
        (b + 1).alias("first"), (F.coalesce(F.get(F.col("blanks"), k + 1), b + 1) - 1).alias("last"))),
        lambda p: p["last"] >= p["first"])
    rows = rows.withColumn("paragraphs", paragraphs)
    line = F.transform("lines", lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("first"), i.alias("last")))
    longer = F.transform(F.filter(F.col("paragraphs"), lambda p: p["last"] > p["first"]), lambda p: F.struct(
        F.lit("paragraph").alias("kind"), p["first"].alias("first"), p["last"].alias("last")))
    whole = F.when(F.size("paragraphs") > 1, F.array(F.struct(
        F.lit("text").alias("kind"), F.get(F.col("paragraphs"), F.lit(0))["first"].alias("first"),
        F.element_at("paragraphs", -1)["last"].alias("last")))).otherwise(F.slice(line, 1, 0))
    words = F.aggregate(F.slice("counts", F.col("u.first") + 1, F.col("u.last") - F.col("u.first") + 1),
                        F.lit(0), lambda a, x: a + x)
    joined = F.array_join(F.filter(F.slice("lines", F.col("u.first") + 1, F.col("u.last") - F.col("u.first") + 1),
                                   lambda x: x != ""), " ")
    return (rows.select("doc_id", "t1", "t2", "lines", "counts", F.explode(F.concat(line, longer, whole)).alias("u"))
            .select("doc_id", "t1", "t2", "u.kind", F.col("u.first").alias("first_line"),
                    F.col("u.last").alias("last_line"), words.alias("words"), joined.alias("text")))


def _bigrams(text: Column) -> Column:
    """Sorted 64-bit hashes of the word bigrams of normalised words."""
    words = F.split(text, " ", -1)
    return F.sort_array(F.transform(F.arrays_zip(F.slice(words, F.lit(1), F.size(words) - 1).alias("a"),
                                                 F.slice(words, F.lit(2), F.size(words) - 1).alias("b")),
                                    lambda p: F.xxhash64(p["a"], p["b"])))


def _numbered(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per bigram with the number of its repetition."""
    return rows.withColumn("grams", _bigrams(F.col("text"))).select(
        *keep, F.explode(F.transform("grams", lambda g, i: F.struct(
            g.alias("gram"), (i + 1 - F.array_position(F.col("grams"), g)).alias("rep")))).alias("g")).select(
        *keep, "g.gram", "g.rep")


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str, str]] = TEMPLATES, min_percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, kind, first_line, last_line, spdx, template, shared, n_unit, n_template, dice) of every unit that
    reaches the threshold, with its best template, and of the windows of words chosen outside of them."""
    spark = documents.sparkSession
    raw = spark.createDataFrame(list(templates), "template string, spdx string, body string")
    held = (raw.select("template", "spdx", F.array_join(F.filter(
        normalised_lines(F.col("body")), lambda x: x != ""), " ").alias("text"))
        .withColumn("n_template", (_n_words(F.col("text")) - 1).cast("long")).where("n_template > 0"))
    rows = held.collect()
    total = sum(r["n_template"] for r in rows)
    if total > MAX_TEMPLATE_BIGRAMS:
        raise ValueError(f"templates have {total} bigrams; at most {MAX_TEMPLATE_BIGRAMS} are broadcast")
    t1, t2 = text_key(F.col(text_col))
    keyed = documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), t1.alias("t1"), t2.alias("t2"))
    possible = materialise(candidates(keyed, held, rows, min_percent))
    some = broadcast_if_small(possible.select("t1", "t2").distinct())
    mine = materialise(keyed.join(some, ["t1", "t2"], "left_semi"))
    texts = materialise(mine.groupBy("t1", "t2").agg(F.first("text").alias("text")))
    found = materialise(unit_matches(texts, held, [r["n_template"] for r in rows], min_percent))
    w = choose_windows(windows(texts, held, possible, min_percent))
    # windows inside a unit that was found are told by it
    by_line = found.where("kind <> 'text'").select(F.col("t1").alias("f1"), F.col("t2").alias("f2"), F.col("last_line").alias("fb"),
                                                   F.explode(F.sequence("first_line", "last_line")).alias("fl"))
    by_text = found.where("kind = 'text'").select(F.col("t1").alias("f1"), F.col("t2").alias("f2"), F.col("first_line").alias("fa"),
                                                  F.col("last_line").alias("fb"))
    same = (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2")) & (F.col("last_line") <= F.col("fb"))
    w = (w.join(by_line, same & (F.col("first_line") == F.col("fl")), "left_anti")
         .join(by_text, same & (F.col("first_line") >= F.col("fa")), "left_anti"))
    ids = mine.select("doc_id", "t1", "t2").distinct()
    out = found.unionByName(w.select(*found.columns)).join(ids, ["t1", "t2"])
    return out.select("doc_id", *[c for c in found.columns if c not in ("t1", "t2")])


def _least(n_template: Column | int, min_percent: int) -> Column:
    """Bigrams that the smallest unit of the threshold must share with a template."""
    t, whole = min_percent, 200 - min_percent
    return F.ceil(t * (F.ceil(n_template * t / whole) + n_template) / 200)


def _template_grams(held: DataFrame) -> DataFrame:
    """(gram, template, spdx, n_template, k): every bigram of every template and how often it has it."""
    return (_numbered(held, ["template", "spdx", "n_template"]).groupBy("gram", "template", "spdx", "n_template")
            .agg(F.count(F.lit(1)).cast("int").alias("k")))


def _gram_places(words: Column, keep: Sequence[str], df: DataFrame) -> DataFrame:
    """(keep, pos, gram): every word bigram with its place."""
    return (df.withColumn("ws", words).where(F.size("ws") > 1)
            .select(*keep, F.posexplode(F.arrays_zip(F.slice("ws", F.lit(1), F.size("ws") - 1).alias("a"),
                                                     F.slice("ws", F.lit(2), F.size("ws") - 1).alias("b"))).alias("pos", "g"))
            .select(*keep, "pos", F.xxhash64("g.a", "g.b").alias("gram")))


def _flat(text: Column) -> Column:
    """All words of a text, in order."""
    return F.array_remove(F.split(F.regexp_replace(ascii_lower(text), GAP, " "), "[ \n]+", -1), "")


def candidates(keyed: DataFrame, held: DataFrame, templates: Sequence, min_percent: int) -> DataFrame:
    """(t1, t2, template) of the texts that hold enough different bigrams of a template for any unit or window."""
    anchors = F.array(*[F.lit(x) for x in _anchors(templates, min_percent)])
    words = keyed.select("t1", "t2", _flat(F.col("text")).alias("w")).where(F.arrays_overlap("w", anchors))
    grams = _template_grams(held)
    # a template of n bigrams, d of them different: n - d of those shared may be repetitions
    need = grams.groupBy("template", "n_template").agg(F.count(F.lit(1)).alias("d")).select(
        "template", F.greatest(F.lit(1), _least(F.col("n_template"), min_percent) - F.col("n_template") + F.col("d")).alias("need"))
    hits = (_gram_places(F.col("w"), ["t1", "t2"], words).drop("pos")
            .join(F.broadcast(grams.select("gram", "template")), "gram"))
    return (hits.groupBy("t1", "t2", "template").agg(F.count_distinct("gram").alias("n"))
            .join(F.broadcast(need), "template").where("n >= need").select("t1", "t2", "template"))


def unit_matches(texts: DataFrame, held: DataFrame, sizes: Sequence[int], min_percent: int) -> DataFrame:
    """(t1, t2, kind, first_line, last_line, spdx, template, shared, n_unit, n_template, dice) of the lines, paragraphs and
    whole texts that reach the threshold, with their best template."""
    t, whole = min_percent, 200 - min_percent
    fits = lambda a, b: (whole * F.least(a, b) >= t * F.greatest(a, b))
    n = F.col("n_unit")
    admitted = F.lit(False)
    for lo, hi in _ranges([(-(-t * s // whole), s * whole // t) for s in sizes]):
        admitted = admitted | n.between(lo, hi)
    cand = units(texts, "t1").withColumn("n_unit", (F.col("words") - 1).cast("long")).where(admitted)
    keys = ["t1", "t2", "kind", "first_line", "last_line", "n_unit"]
    mine = _numbered(cand, keys)
    theirs = F.broadcast(_numbered(held, ["template", "spdx", "n_template"]).withColumnsRenamed(
        {"gram": "t_gram", "rep": "t_rep"}))
    pairs = (mine.join(theirs, (F.col("gram") == F.col("t_gram")) & (F.col("rep") == F.col("t_rep"))
                       & fits(F.col("n_unit"), F.col("n_template")))
             .groupBy(*keys, "template", "spdx", "n_template").agg(F.count_distinct("gram", "rep").alias("shared"))
             .where(200 * F.col("shared") >= t * (F.col("n_unit") + F.col("n_template"))))
    dice = 2.0 * F.col("shared") / (F.col("n_unit") + F.col("n_template"))
    # the smallest (-dice, template id): the smaller id wins a tie
    top = pairs.withColumn("dice", dice).groupBy(*keys).agg(F.min(F.struct((-F.col("dice")).alias("d"), "template", "spdx", "shared",
                                                                           "n_template")).alias("b"))
    return top.select("t1", "t2", "kind", "first_line", "last_line", "b.spdx", "b.template", "b.shared",
                      "n_unit", "b.n_template", (-F.col("b.d")).alias("dice"))


def _anchors(held: Sequence, min_percent: int) -> list[str]:
    """Words of which every window that reaches the threshold holds at least one.

    The bigrams of a template without any of its chosen words (long ones first, stop words last) are fewer than
    the smallest window must share.
    """
    out: set[str] = set()
    stopped = set(ENGLISH)
    for r in held:
        w = r["text"].split(" ")
        m = len(w) - 1
        smallest = -(-min_percent * m // (200 - min_percent))
        left = {(w[i], w[i + 1], i) for i in range(m)}
        for word in sorted(set(w), key=lambda x: (x in stopped, -len(x), x)):
            if 200 * len(left) < min_percent * (smallest + m):
                break
            out.add(word)
            left = {g for g in left if word not in g[:2]}
    return sorted(out)


def _worded(texts: DataFrame) -> DataFrame:
    """(t1, t2, pos, gram, la, lb, n_line): the word bigrams of every text with their place, the lines of their two words
    and the bigrams that the first of these lines has."""
    lines = texts.select("t1", "t2", F.posexplode(normalised_lines(F.col("text"))).alias("line", "x")).where("x <> ''")
    before = Window.partitionBy("t1", "t2").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = (lines.withColumn("ws", F.array_remove(F.split("x", " ", -1), "")).drop("x")
             .withColumn("at", F.coalesce(F.sum(F.size("ws")).over(before), F.lit(0))))
    words = (lines.select("t1", "t2", "line", "at", (F.size("ws") - 1).alias("n_line"), F.posexplode("ws").alias("i", "w"))
             .select("t1", "t2", "line", "n_line", (F.col("at") + F.col("i")).cast("int").alias("pos"), "w"))
    order = Window.partitionBy("t1", "t2").orderBy("pos")
    return (words.select("t1", "t2", "pos", F.col("line").alias("la"), F.lead("line").over(order).alias("lb"), "n_line", "w",
                         F.lead("w").over(order).alias("v"))
            .where("v is not null").select("t1", "t2", "pos", "la", "lb", "n_line", F.xxhash64("w", "v").alias("gram")))


def windows(texts: DataFrame, held: DataFrame, possible: DataFrame, min_percent: int) -> DataFrame:
    """(t1, t2, s, e, first_line, last_line, spdx, template, shared, n_unit, n_template, dice) of the best run of words from every
    start, whatever lines and paragraphs it crosses, that reaches the threshold.

    ``possible`` are the (t1, t2, template) worth looking at.  Only bigrams of the template are kept, with
    their places; a window starts and ends at such bigrams.  A bigram that a template has k times counts unless its k-th
    last occurrence lies inside the window too, which gives the multiset intersection.  Runs inside a line of the template's
    size or a little less are left out: such a line has been compared as it is, and cutting off its changed ends would only
    make it look better.  Starts and bigrams meet in
    cells as long as the longest window, so a text costs in proportion to its length.
    """
    t, whole = min_percent, 200 - min_percent
    theirs = materialise(_template_grams(held))
    most = theirs.agg(F.max("k")).first()[0] or 1
    keys = ["t1", "t2", "template"]
    hits = _worded(texts).join(F.broadcast(theirs), "gram").join(possible, keys, "left_semi")
    last = F.collect_list("pos").over(Window.partitionBy(*keys, "gram").orderBy("pos").rowsBetween(-most, 0))
    longest = F.floor(F.col("n_template") * whole / t).cast("int")
    hits = hits.withColumn("last", last).select(
        *keys, "spdx", "n_template", "pos", "la", "lb", "n_line", longest.alias("longest"),
        F.get(F.col("last"), F.size("last") - 1 - F.col("k")).alias("before"))
    ahead = F.count(F.lit(1)).over(Window.partitionBy(*keys).orderBy(F.col("pos") / F.col("longest")).rangeBetween(0, 1))
    hits = materialise(hits.withColumn("ahead", ahead))
    cell = F.floor(F.col("pos") / F.col("longest"))
    starts = hits.where(F.col("ahead") >= _least(F.col("n_template"), min_percent)).select(
        *keys, F.col("pos").alias("s"), F.col("la").alias("first_line"), F.col("n_line").alias("n_first"), F.explode(F.array(cell, cell + 1)).alias("cell"))
    inside = (hits.withColumn("cell", cell).join(starts, [*keys, "cell"])
              .where((F.col("pos") >= F.col("s")) & (F.col("pos") < F.col("s") + F.col("longest"))
                     & (F.col("before").isNull() | (F.col("before") < F.col("s")))))
    ends = (inside.withColumn("shared", F.row_number().over(Window.partitionBy(*keys, "s").orderBy("pos")).cast("long"))
            .withColumn("n_unit", (F.col("pos") - F.col("s") + 1).cast("long"))
            .where((200 * F.col("shared") >= t * (F.col("n_unit") + F.col("n_template"))) & ~(
                (F.col("first_line") == F.col("lb")) & (F.col("n_first") <= F.col("n_template"))
                & (whole * F.col("n_first") >= t * F.col("n_template"))))
            .withColumn("dice", 2.0 * F.col("shared") / (F.col("n_unit") + F.col("n_template"))))
    best = F.max_by(F.struct("first_line", F.col("lb").alias("last_line"), "spdx", "shared", "n_unit", "n_template", "dice",
                             F.col("pos").alias("e")), F.struct("dice", "n_unit"))
    return ends.groupBy(*keys, "s").agg(best.alias("b")).select(*keys, "s", "b.*").withColumn("kind", F.lit("window"))


def choose_windows(found: DataFrame) -> DataFrame:
    """The windows that stay when better ones (Dice, then length, template id and place) go first and those that overlap
    them go.

    In rounds: a window that no undecided better one overlaps stays, what overlaps one that stays goes, until
    none is undecided.  Windows that overlap start within one longest window of each other, hence in the same or
    neighbouring cells.
    """
    left = materialise(found.withColumn("o", F.struct((-F.col("dice")).alias("d"), (-F.col("n_unit")).alias("n"), "template", "s")))
    span = left.agg(F.max(F.col("e") - F.col("s") + 1)).first()[0]
    if span is None:
        return found
    left = left.withColumn("cell", F.floor(F.col("s") / span))

    def near(rows: DataFrame) -> DataFrame:
        c = F.col("cell")
        return rows.select(F.col("t1").alias("o1"), F.col("t2").alias("o2"), F.col("s").alias("os"), F.col("e").alias("oe"),
                           F.col("o").alias("oo"), F.explode(F.array(c - 1, c, c + 1)).alias("oc"))

    touch = ((F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2")) & (F.col("cell") == F.col("oc"))
             & (F.col("os") <= F.col("e")) & (F.col("oe") >= F.col("s")))
    kept = None
    while True:
        top = materialise(left.join(near(left), touch & (F.col("oo") < F.col("o")), "left_anti"))
        kept = top if kept is None else kept.unionByName(top)
        left = materialise(left.join(near(top), touch, "left_anti"))
        if left.isEmpty():
            return kept.drop("o", "cell")


def _ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of integer ranges."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out
