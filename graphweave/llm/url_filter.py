"""URL filters: host and path rules by hashed expressions.

1. A URL's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; its path is what
   follows up to ``?``, ``#`` or the end.
2. The URL is expanded into host-suffix and path-prefix expressions: the last 1, 2, ... labels of the host (as many as the
   longest rule host has) times the path prefixes of the lengths that rules have.
3. Expressions and rules meet in an equi-join on the first 32 bits of their SHA-256; then the full digests are compared.
4. Of the rules that are left the longest wins (rule text, then host); of equal rules with both verdicts ``block`` wins.
   A URL that no rule fits gets ``default``.

The rules are broadcast only behind a check of rows and bytes.  A larger list is joined by shuffle, with the rules copied to
``SALT`` salts and every expression sent to one of them, so an expression that very many URLs share is split.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets ``default``; rules
without a host fit nothing; repeated rows and ids are judged separately; an empty table gives an empty result; an empty rule
list gives ``default`` everywhere; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave.llm.common import ascii_lower, materialise
from graphweave.operators.common import fits_broadcast

SALT = 16
DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return ascii_lower(raw), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """(r_key, r_digest, n_labels, n_path, r_len, r_host, r_block, r_text, r_verdict) from (host, path, verdict)."""
    r = (rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
         .where((F.coalesce("host", F.lit("")) != "") & F.col("verdict").isNotNull()).distinct())
    digest = _digest(F.col("host"), F.col("path"))
    return r.select(
        F.substring(digest, 1, 8).alias("r_key"), digest.alias("r_digest"),
        F.size(F.split("host", "\\.")).alias("n_labels"), F.char_length("path").alias("n_path"),
        (F.char_length("host") + F.char_length("path")).alias("r_len"), F.char_length("host").alias("r_host"),
        (F.col("verdict") == "block").alias("r_block"), F.concat("host", "path").alias("r_text"),
        F.col("verdict").alias("r_verdict"))


def expressions(host: Column, path: Column, max_labels: int, path_lengths: list[int]) -> Column:
    """Digests of all host-suffix and path-prefix expressions of a URL that a rule could equal."""
    labels = F.split(host, "\\.", -1)
    count = F.least(F.size(labels), F.lit(max_labels))
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.char_length(path)),
                           lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _digest(s, p))))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``; ``rules`` are (host, path, verdict)."""
    host, path = host_and_path(F.col(url_col))
    rows = materialise(pages.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                                    host.alias("host"), path.alias("path")))
    table = materialise(rule_table(rules))
    # one number, and at most as many as a path has characters
    shape = table.agg(F.max("n_labels").alias("labels"), F.sort_array(F.collect_set("n_path")).alias("lengths")).first()
    plain = [F.col("id").alias(id_col), "host", "path"]
    if shape["labels"] is None:
        return rows.select(*plain, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    found = rows.where(F.col("host") != "").select("uid", F.explode(expressions(
        F.col("host"), F.col("path"), shape["labels"], list(shape["lengths"]))).alias("digest"))
    found = found.withColumn("key", F.substring("digest", 1, 8))
    same = F.col("key") == F.col("r_key")
    if fits_broadcast(table):
        table = F.broadcast(table)
    else:
        table = table.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        found = found.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALT)).cast("int"))
        same = same & (F.col("salt") == F.col("r_salt"))
    fitting = found.join(table, same).where(F.col("digest") == F.col("r_digest"))
    best = fitting.groupBy("uid").agg(F.max(F.struct("r_len", "r_host", "r_block", "r_text", "r_verdict")).alias("b"))
    return rows.join(best, "uid", "left").select(
        *plain, F.col("b.r_text").alias("rule"), F.coalesce("b.r_verdict", F.lit(default)).alias("verdict"))
