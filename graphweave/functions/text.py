"""Scalar text functions (Column -> Column), all built-in Spark expressions.

Each function mirrors one text rule of the linking jobs; the rule is named in
the docstring.  No Python UDFs here: everything stays inside whole-stage
codegen (or, for the array lambdas, inside the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the original rules) --------------------------
# The 32 ASCII punctuation marks removed by text normalization, in ASCII order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Characters Python's str.strip()/str.split() treat as white space.  The same
# class is valid in Java regex and in RE2 (used by the SQL oracle).
WS = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_CHARS = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing white space of any kind."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def ws_split(c) -> Column:
    """Python ``str.split()`` without argument: white-space runs, no empty tokens."""
    return F.filter(F.split(strip(c), f"{WS}+"), lambda x: x != "")


def normalize_text(c, collapse: bool = False) -> Column:
    """Lower case, delete ASCII punctuation, strip, newline -> blank.

    Runs of white space are *not* collapsed (the original's docstring says
    they are, its code does not); ``collapse=True`` collapses them.
    """
    out = strip(F.translate(F.lower(col_(c)), "\n" + PUNCTUATION, " "))
    if collapse:
        out = F.regexp_replace(out, f"{WS}+", " ")
    return out


def normalize_text_safe(c) -> Column:
    """Null-safe variant: a missing value normalizes to ''."""
    return F.coalesce(normalize_text(c), F.lit(""))


def normalize_category(c) -> Column:
    """Category rule: lower, runs of '-'/'_' become one blank, strip."""
    return strip(F.regexp_replace(F.lower(col_(c)), "[-_]+", " "))


def normalize_doi(c) -> Column:
    """DOI rule: missing -> '', lower, strip."""
    return strip(F.lower(F.coalesce(col_(c), F.lit(""))))


def coerce_date(c) -> Column:
    """Parse a date/time text, bad values become null, format yyyy-MM-dd."""
    return F.date_format(F.try_to_timestamp(col_(c)), "yyyy-MM-dd")


def to_date_or_null(c) -> Column:
    """Graph-load ``date(text)``: a DATE, null when the text is not a date."""
    return F.try_to_date(col_(c))


def blank_trim(c) -> Column:
    """``(x or '').strip()``."""
    return strip(F.coalesce(col_(c), F.lit("")))


def join_skip_nulls(*cols) -> Column:
    """Blank-joined text of the given columns, missing ones skipped."""
    return F.concat_ws(" ", *[col_(c) for c in cols])


def join_nulls_as_empty(*cols) -> Column:
    """Blank-joined text, a missing column counts as '' (double blanks stay)."""
    return F.concat_ws(" ", *[F.coalesce(col_(c), F.lit("")) for c in cols])


def name_dot_definition(name, definition) -> Column:
    """Technology text ``name. definition`` (missing definition -> '')."""
    return F.concat(blank_trim(name), F.lit(". "), blank_trim(definition))


def long_tokens(c, min_len: int = 5) -> Column:
    """Tokens of a normalized name longer than four characters."""
    return F.filter(ws_split(c), lambda t: F.length(t) >= min_len)


def round3(c) -> Column:
    """Python ``round(x, 3)`` (half to even)."""
    return F.bround(col_(c), 3)


def split_set(c) -> Column:
    """Lower, split on ',' or ';', strip parts, drop blanks, distinct."""
    parts = F.split(F.lower(F.coalesce(col_(c), F.lit(""))), "[,;]")
    return F.array_distinct(F.filter(F.transform(parts, strip), lambda x: x != ""))


def split_labels(c, sep: str = ";") -> Column:
    """Labels joined by ``sep`` -> array of stripped, non-blank labels."""
    return F.filter(F.transform(F.split(F.coalesce(col_(c), F.lit("")), sep), strip), lambda x: x != "")


def split_or_empty(c, sep: str = ";") -> Column:
    """Graph-load ``coalesce(split(x, ';'), [])`` with each element stripped."""
    return F.coalesce(F.transform(F.split(col_(c), sep), strip), F.array().cast("array<string>"))


def flatten_names(c, key: str = "display_name") -> Column:
    """Array of structs -> sorted distinct normalized ``key`` values joined by ';'.

    Elements whose ``key`` is missing or '' are skipped; a missing array gives ''.
    """
    kept = F.filter(col_(c), lambda x: x[key].isNotNull() & (x[key] != ""))
    names = F.sort_array(F.array_distinct(F.transform(kept, lambda x: normalize_text(x[key]))))
    return F.coalesce(F.array_join(names, ";"), F.lit(""))


def join_display_names(c, key: str = "display_name", sep: str = "; ") -> Column:
    """Array of structs -> stripped ``key`` values in order, joined by '; '."""
    kept = F.filter(F.coalesce(col_(c), F.array()), lambda x: x[key].isNotNull() & (x[key] != ""))
    return F.array_join(F.transform(kept, lambda x: strip(x[key])), sep)


def token_sort(c) -> Column:
    """Tokens sorted and joined by one blank (token-sort form of a string)."""
    return F.array_join(F.sort_array(ws_split(c)), " ")
