"""SQL text snippets (DuckDB dialect) used by the oracle queries.

Each helper mirrors one Column function of ``graphweave.functions`` so the
oracle computes the same rule independently of Spark.  Values that must be
equal (punctuation set, white-space class, stop words) come from the same
constants.
"""

from __future__ import annotations

from ..functions.stopwords import ENGLISH
from ..functions.text import PUNCTUATION, WS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def norm(x: str) -> str:
    """lower -> delete punctuation -> strip -> newline to blank."""
    deleted = f"translate(lower({x}), {lit(PUNCTUATION)}, '')"
    return f"replace({strip(deleted)}, chr(10), ' ')"


def norm_safe(x: str) -> str:
    return f"coalesce({norm(x)}, '')"


def ws_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({strip(x)}, {lit(WS + '+')}), lambda t: t <> '')"


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort({ws_split(x)}), ' ')"


def category(x: str) -> str:
    return strip(f"regexp_replace(lower({x}), '[-_]+', ' ', 'g')")


def lcs(a: str, b: str) -> str:
    """LCS length by the bit-parallel recurrence on HUGEINT (shorter side <= 126 chars)."""
    p = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)"
    t = f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"
    full = f"((1::HUGEINT << length({p})) - 1)"
    mask = (f"list_reduce(list_transform(range(length({p})), lambda i: CASE WHEN {p}[i + 1] = c "
            f"THEN (1::HUGEINT << i) ELSE 0::HUGEINT END), lambda x, y: x | y, 0::HUGEINT)")
    v = (f"list_reduce(list_transform(string_split({t}, ''), lambda c: {mask}), "
         f"lambda v, m: ((v + (v & m)) | (v & ~m)) & {full}, {full})")
    return f"(CASE WHEN length({p}) = 0 THEN 0 ELSE length({p}) - bit_count({v}) END)"


def ratio(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 "
            f"ELSE 200.0 * {lcs(a, b)} / (length({a}) + length({b})) END)")


def stop_list() -> str:
    return "[" + ", ".join(lit(w) for w in ENGLISH) + "]"


def ngram_terms(x: str) -> str:
    """Word tokens (2+ word chars), stop words removed, then uni+bigrams."""
    toks = f"regexp_extract_all(lower(coalesce({x}, '')), '[\\p{{L}}\\p{{N}}\\p{{M}}_]{{2,}}')"
    kept = f"list_filter({toks}, lambda w: NOT list_contains({stop_list()}, w))"
    return (f"(SELECT k || list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]) "
            f"FROM (SELECT {kept} AS k))")


def token_set(a: str, b: str) -> str:
    """Token-set ratio (0..100) of raw texts; a, b must be plain column names."""
    ta = f"list_distinct({ws_split(a)})"
    tb = f"list_distinct({ws_split(b)})"
    return f"""(SELECT CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0
        WHEN length(sect) > 0 AND (length(ab) = 0 OR length(ba) = 0) THEN 100.0
        WHEN length(sect) = 0 THEN CASE WHEN length(ab) + length(ba) = 0 THEN 100.0
             ELSE 100.0 * (1 - (length(ab) + length(ba) - 2 * {lcs('ab', 'ba')}) / (length(ab) + length(ba))) END
        ELSE greatest(
             100.0 * (1 - (length(ab) + length(ba) - 2 * {lcs('ab', 'ba')})
                          / (2 * length(sect) + 2 + length(ab) + length(ba))),
             100.0 * (1 - (1 + length(ab)) / (2 * length(sect) + 1 + length(ab))),
             100.0 * (1 - (1 + length(ba)) / (2 * length(sect) + 1 + length(ba)))) END
      FROM (SELECT ta, tb,
                   array_to_string(list_sort(list_intersect(ta, tb)), ' ') AS sect,
                   array_to_string(list_sort(list_filter(ta, lambda x: NOT list_contains(tb, x))), ' ') AS ab,
                   array_to_string(list_sort(list_filter(tb, lambda x: NOT list_contains(ta, x))), ' ') AS ba
            FROM (SELECT {ta} AS ta, {tb} AS tb)))"""


def lcs_long(a: str, b: str) -> str:
    """LCS length without a bound on the lengths: element l + 1 of the list is the shortest
    prefix of the shorter side that holds a common subsequence of length l."""
    p = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)"
    t = f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"
    after = (f"list_transform(range(length({p}) + 2), lambda j: CASE WHEN instr(substr({p}, j + 1), c) > 0 "
             f"THEN j + instr(substr({p}, j + 1), c) ELSE length({p}) + 1 END)")
    last = (f"list_reduce(list_transform(string_split({t}, ''), lambda c: {after}), "
            f"lambda k, n: list_transform(range(1, len(k) + 1), lambda l: CASE WHEN l = 1 THEN 0 "
            f"ELSE least(k[l], n[k[l - 1] + 1]) END), "
            f"list_transform(range(length({p}) + 1), lambda i: CASE WHEN i = 0 THEN 0 ELSE length({p}) + 1 END))")
    return f"(CASE WHEN length({p}) = 0 THEN 0 ELSE len(list_filter({last}, lambda x: x <= length({p}))) - 1 END)"
