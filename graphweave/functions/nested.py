"""Nested array / struct / map functions (Column -> Column).

All are Spark higher-order functions evaluated per row inside the JVM; the
work per row is bounded by the size of that row's arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, strip


def empty_str_array() -> Column:
    return F.array().cast("array<string>")


def text_from_inverted_index(c) -> Column:
    """Rebuild text from ``map<word, array<position>>``.

    Words are ordered by position, gaps are skipped, and when two words claim
    the same position the later map entry wins.  A null map gives null.
    """
    m = col_(c)
    triples = F.flatten(F.transform(
        F.map_entries(m),
        lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("pos"), i.alias("ord"), e["key"].alias("word")))))
    ordered = F.sort_array(triples)
    # keep an element when the next one has another position (zip_with pads
    # the shorter array with nulls); each array is evaluated once per row
    nxt = F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0)))
    words = F.zip_with(ordered, nxt, lambda x, y: F.when(y.isNull() | (y["pos"] != x["pos"]), x["word"]))
    return F.when(m.isNotNull(), F.array_join(F.filter(words, lambda w: w.isNotNull()), " "))


def with_text_from_inverted_index(df, c: str, out: str):
    """DataFrame form of ``text_from_inverted_index`` for large maps: the
    sorted entry array is its own projection (computed once per row)."""
    p = f"__{out}_o"
    m = F.col(c)
    triples = F.flatten(F.transform(
        F.map_entries(m),
        lambda e, i: F.transform(e["value"], lambda q: F.struct(q.alias("pos"), i.alias("ord"), e["key"].alias("word")))))
    d = df.withColumn(p, F.sort_array(triples))
    o = F.col(p)
    nxt = F.slice(o, 2, F.greatest(F.size(o) - 1, F.lit(0)))
    words = F.zip_with(o, nxt, lambda x, y: F.when(y.isNull() | (y["pos"] != x["pos"]), x["word"]))
    return d.withColumn(out, F.when(m.isNotNull(), F.array_join(F.filter(words, lambda w: w.isNotNull()), " "))).drop(p)


def with_inverted_index(df, tokens: str, out: str):
    """Add ``out``: map<word, array<position>> of a token array, built inside
    the row (native sort of (word, position) pairs, then runs of equal words),
    so no shuffle is needed: the index of a document depends on that
    document only.  Keys appear in word order; a document without tokens has an
    empty map, null tokens give a null map."""
    p = f"__{out}_"
    d = df.withColumn(p + "s", F.sort_array(F.transform(F.col(tokens), lambda w, i: F.struct(w.alias("w"), i.alias("p")))))
    srt = F.col(p + "s")
    n = F.size(srt)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                      lambda i: (i <= n) & F.when(i == 1, F.lit(True))
                      .otherwise(F.element_at(srt, i)["w"] != F.element_at(srt, i - 1)["w"]))
    d = d.withColumn(p + "st", F.when(n > 0, starts).otherwise(F.array().cast("array<int>")))
    st = F.col(p + "st")
    # as many ends as starts: without tokens there is neither
    last = F.when(n > 0, F.array(n + 1)).otherwise(F.array().cast("array<int>"))
    ends = F.concat(F.slice(st, 2, F.greatest(F.size(st) - 1, F.lit(0))), last)
    entries = F.zip_with(st, ends, lambda a, b: F.struct(
        F.element_at(srt, a)["w"].alias("key"),
        F.transform(F.slice(srt, a, b - a), lambda x: x["p"]).alias("value")))
    return d.withColumn(out, F.when(srt.isNotNull(), F.map_from_entries(entries))).drop(p + "s", p + "st")


def slim_authors(c) -> Column:
    """Authorships -> (author_position, display_name, orcid)."""
    return F.transform(F.coalesce(col_(c), F.array()), lambda a: F.struct(
        a["author_position"].alias("author_position"),
        a["author"]["display_name"].alias("display_name"),
        a["author"]["orcid"].alias("orcid")))


def unique_by_id(arr, key: str = "id") -> Column:
    """Keep one element per ``key``: first position, last value; null keys dropped."""
    a = F.filter(arr, lambda x: x[key].isNotNull())
    ids = F.array_distinct(F.transform(a, lambda x: x[key]))
    return F.transform(ids, lambda k: F.element_at(F.filter(a, lambda x: x[key] == k), -1))


def paper_institutions(authorships) -> Column:
    """Institutions of all authors without ``lineage``, unique by id."""
    flat = F.flatten(F.transform(
        F.coalesce(col_(authorships), F.array()),
        lambda a: F.transform(F.coalesce(a["institutions"], F.array()), lambda i: F.struct(
            i["id"].alias("id"), i["display_name"].alias("display_name"), i["ror"].alias("ror"),
            i["country_code"].alias("country_code"), i["type"].alias("type")))))
    return unique_by_id(flat)


def slim_keywords(c) -> Column:
    return F.transform(F.coalesce(col_(c), F.array()), lambda k: F.struct(
        k["id"].alias("id"), k["display_name"].alias("display_name"), k["score"].alias("score")))


def slim_topics(c) -> Column:
    return F.transform(F.coalesce(col_(c), F.array()), lambda t: F.struct(
        t["display_name"].alias("display_name"), t["score"].alias("score")))


def topic_level(c, level: str) -> Column:
    """Unique (id, display_name) of ``topics[].<level>`` (subfield/field/domain)."""
    present = F.filter(F.coalesce(col_(c), F.array()), lambda t: t[level].isNotNull())
    items = F.transform(present, lambda t: F.struct(
        t[level]["id"].alias("id"), t[level]["display_name"].alias("display_name")))
    return unique_by_id(items)


def first_of_type(arr, type_value: str, type_field: str = "location_type", value_field: str = "value") -> Column:
    """First element's ``value`` whose type matches, else null (blank counts as missing)."""
    hit = F.filter(F.coalesce(col_(arr), F.array()), lambda x: x[type_field] == type_value)
    return F.nullif(F.try_element_at(F.transform(hit, lambda x: x[value_field]), F.lit(1)), F.lit(""))


def first_location(arr) -> Column:
    """City, else region, else country, else ''."""
    return F.coalesce(first_of_type(arr, "city"), first_of_type(arr, "region"),
                      first_of_type(arr, "country"), F.lit(""))


def category_permalinks(c) -> Column:
    """Category permalinks with blanks dropped."""
    kept = F.filter(F.coalesce(col_(c), F.array()), lambda x: x["permalink"].isNotNull() & (x["permalink"] != ""))
    return F.transform(kept, lambda x: x["permalink"])


def struct_or_text_value(c) -> Column:
    """A field holding either ``{"value": ...}`` as JSON text or a plain value.

    A JSON object without ``value`` gives a blank, never its own text.
    """
    v = col_(c)
    is_object = F.get_json_object(v, "$").startswith("{")
    return strip(F.coalesce(F.when(is_object, F.coalesce(F.get_json_object(v, "$.value"), F.lit(""))).otherwise(v),
                            F.lit("")))


def parse_reply_array(c, sentinel: str = "I don't know") -> Column:
    """A reply that should be a JSON array of strings -> array<string>.

    Invalid JSON, the sentinel and missing replies all give an empty array.
    """
    v = col_(c)
    parsed = F.from_json(v, "array<string>", {"mode": "PERMISSIVE"})
    return F.when(v.isNull() | (strip(v) == sentinel), empty_str_array()).otherwise(
        F.coalesce(parsed, empty_str_array()))
