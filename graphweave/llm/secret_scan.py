"""Secret scan with a random forest that removes false positives.

1. Corpus statistics over all documents: counts of character transitions (a fixed
   38 x 38 table) and the ``DICTIONARY`` most frequent words, both summed by Spark.
2. Candidates: assignments to a credential-like name, well-known key formats, and long
   mixed tokens.  Deliberately broad.  A value has no greatest length: a quoted one goes to its closing quote, another is the
   whole run of its characters; a private key goes from its BEGIN line to its END line if only key lines lie between them, else
   over all following lines of key characters.  Candidates that overlap are one, from the first start to the last end.
3. Features of a candidate: its length and character classes, its transitions
   (changes of class, mean log-probability under the corpus table), how much of it
   dictionary words cover, its path (or source) and its neighbouring words.
4. A random forest, trained from labelled findings, gives the probability that a
   candidate is a secret; findings under ``THRESHOLD`` are false positives.

``labelled_findings`` makes the default training table: a documented, bounded number of
findings (``N_LABELLED``) with generated values of known kind placed in
contexts made of the corpus' own words.  A caller's table of labelled findings
(value, left, right, path, label) is used in the same way.

Only the transition table, the dictionary and the forest reach every task; all are
of fixed size.

Defined results: null and empty texts have no candidates; a table without the path
column has empty paths; repeated rows give
their findings each; an empty table gives an empty result; other columns pass
through ``redact`` untouched.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphweave.llm.common import as_row, ascii_lower, from_row, materialise, spread, text_key
from graphweave.llm.quality import BUCKET

DICTIONARY = 4096
N_LABELLED = 6000
THRESHOLD = 0.5
CONTEXT = 48
PLACEHOLDER = "<SECRET>"

# Public formats and names.
NAMES = r"token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|auth|credentials?|private[_-]?key|client[_-]?key"
_LINE = r"(?:\r?\n|\\r\\n|\\n|\\r)"
_KEY_LINE = r"[ \t]*+(?:(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n]*+|[A-Za-z0-9+/=]*+)[ \t\"',+]*+"
# A key goes to its END line only over lines that keys are made of; without one, over all such lines that follow.
_KEY = (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
        r"(?:[ \t]*+(?:[A-Za-z0-9+/=]{20,}+[ \t]*+)*+(?:[A-Za-z0-9+/=]++[ \t]*+)?(?:" + _LINE + _KEY_LINE + r")*?-----END [A-Z ]{0,30}PRIVATE KEY-----"
        r"|(?:[ \t]*[A-Za-z0-9+/=]{20,})?(?:" + _LINE + r"[ \t]*(?:(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n]*"
        r"|[A-Za-z0-9+/=]*)[ \t]*(?=[\r\n\"']|\\r|\\n|\Z))*)")
# (rule, what every match holds as it stands, pattern)
RULES: list[tuple[str, tuple[str, ...], str]] = [
    ("private_key", ("-----BEGIN ",), _KEY),
    ("aws", ("AKIA", "ASIA"), r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", ("xox",), r"(?<![A-Za-z0-9])xox[abeprs]-[A-Za-z0-9-]{10,}"),
    ("stripe", ("k_live_", "k_test_"), r"(?<![A-Za-z0-9])[sr]k_(?:live|test)_[0-9a-zA-Z]{16,}"),
    ("google", ("AIza",), r"(?<![A-Za-z0-9])AIza[0-9A-Za-z_-]{35,}"),
    ("jwt", ("eyJ",), r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
    # a name and what is assigned to it: a quoted value goes to its closing quote on the line
    ("assigned", (":", "="), r"(?<![A-Za-z0-9_.-])(?P<n>[A-Za-z0-9_.-]++)[\"']?+[ \t]*+[:=]{1,2}>?[ \t]*+"
     r"(?:(?P<q>[\"'`])(?P<v>(?:\\.|(?!(?P=q))[^\\\r\n])*+)(?P=q)|[\"'`]?(?P<w>[^\s\"'`,;<>]{8,}+))"),
    ("token", (), r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+"),
]
MIN_VALUE = 8
CREDENTIAL = re.compile(NAMES + r"|bearer|apikey|key", re.I)
HARMLESS = re.compile(r"sha\d*|md5|hash|checksum|digest|commit|revision|uuid|guid|etag|version|build|example|sample|dummy"
                      r"|placeholder|your|test|xxxx|changeme|isbn|phone|doi|http|www", re.I)
PATHS = re.compile(r"test|example|sample|doc|mock|fixture|demo|spec", re.I)

FEATURES = ["length", "log_length", "digits", "upper", "lower", "other", "hex", "distinct", "entropy", "changes",
            "transition", "coverage", "words", "path_harmless", "near_credential", "near_harmless", "assigned", "quoted",
            "value_harmless", "known_format"]
N_CLASS = 38


def _codes(data: bytes) -> np.ndarray:
    """Character classes of bytes: 0 other, 1-26 letters, 27-36 digits, 37 space."""
    return _CLASS[np.frombuffer(data, dtype=np.uint8)]


_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = np.arange(27, 37)
_CLASS[[32, 9, 10, 13]] = 37


def transition_counts(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of neighbouring character classes over all texts (38 x 38)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(N_CLASS * N_CLASS, dtype=np.int64)
        for b in batches:
            for t in b["text"]:
                c = _codes(t.encode("utf-8", "surrogatepass"))
                if len(c) > 1:
                    total += np.bincount(c[:-1] * N_CLASS + c[1:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at, "c": total[at]})
    rows = spread(documents.select(F.col(text_col).alias("text")).where(F.col(text_col).isNotNull()))
    out = np.zeros(N_CLASS * N_CLASS, dtype=np.float64)
    for r in rows.mapInPandas(run, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).collect():
        out[r["pair"]] = r["c"]
    return out.reshape(N_CLASS, N_CLASS)


def frequent_words(documents: DataFrame, text_col: str = "text", n: int = DICTIONARY) -> list[str]:
    """The ``n`` most frequent words of 3 to 12 letters a-z, counted over all texts; ties by word.

    Counts of counts in log-linear buckets (at most 2,048 rows) give a floor that
    at least ``n`` words reach, so that the final sort sees hardly more than ``n``
    words, whatever the number of partitions.
    """
    words = F.explode(F.split(F.regexp_replace(ascii_lower(F.col(text_col)), "[^a-z]+", " "), " "))
    counted = materialise(documents.where(F.col(text_col).isNotNull()).select(words.alias("w"))
                          .where(F.char_length("w").between(3, 12)).groupBy("w").agg(F.count(F.lit(1)).alias("v")))
    floor, reached = 0, 0
    for r in sorted(counted.groupBy(F.expr(BUCKET).alias("b")).count().collect(), reverse=True):
        floor, reached = r["b"], reached + r["count"]
        if reached >= n:
            break
    top = counted.where(F.col("v") >= floor).orderBy(F.col("v").desc(), "w").limit(n)
    return [r["w"] for r in top.collect()]


class Features:
    """Feature vectors from fixed-size corpus statistics."""

    def __init__(self, transitions: np.ndarray, words: list[str]):
        smooth = transitions + 1.0
        self.logp = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        self.words = frozenset(words)

    def coverage(self, value: str) -> tuple[float, int]:
        """Share of characters covered by dictionary words (longest first from the left), and how many words."""
        low, at, hit, n = value.lower(), 0, 0, 0
        while at < len(low):
            for size in range(min(12, len(low) - at), 2, -1):
                if low[at:at + size] in self.words:
                    hit, n, at = hit + size, n + 1, at + size
                    break
            else:
                at += 1
        return hit / max(1, len(low)), n

    def vector(self, value: str, left: str, right: str, path: str, rule: str) -> list[float]:
        data = value.encode("utf-8", "surrogatepass")
        n = max(1, len(data))
        buf = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(1, dtype=np.uint8)
        kind = np.where((buf >= 48) & (buf <= 57), 0, np.where((buf >= 65) & (buf <= 90), 1,
                                                              np.where((buf >= 97) & (buf <= 122), 2, 3)))
        share = np.bincount(kind, minlength=4) / n
        freq = np.bincount(buf)
        freq = freq[freq > 0] / len(buf)
        c = _CLASS[buf]
        covered, words = self.coverage(value)
        return [float(len(data)), math.log(n), float(share[0]), float(share[1]), float(share[2]), float(share[3]),
                float(re.fullmatch(r"[0-9a-fA-F]+", value) is not None), len(set(data)) / n,
                float(-(freq * np.log2(freq)).sum()), float((kind[1:] != kind[:-1]).sum() / n),
                float(self.logp[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0, covered, float(words),
                float(PATHS.search(path) is not None), float(CREDENTIAL.search(left) is not None),
                float(HARMLESS.search(left) is not None), float(re.search(r"[:=]\s*[\"']?$", left) is not None),
                float(left[-1:] in "\"'" and left != ""), float(HARMLESS.search(value) is not None),
                float(rule not in ("assigned", "token"))]


def _spans(rule: str, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    """Places of one rule's values."""
    if rule != "assigned":
        for m in pattern.finditer(text):
            if rule != "token" or _DIGIT.search(text, *m.span()):
                yield m.span()
        return
    at = 0
    while m := pattern.search(text, at):
        # only credential-like names count; another name's value may hold an assignment itself
        at = m.end("n")
        if _NAME.search(m["n"]):
            span = m.span("v") if m["v"] is not None else m.span("w")
            if span[1] - span[0] >= MIN_VALUE:
                yield span
                at = m.end()


def find_candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule) in code points.  Overlapping findings are one, from the first start to the last end, named by the
    first of their rules."""
    found = []
    for order, (rule, held, pattern) in enumerate(_compiled()):
        if not held or any(x in text for x in held):
            found += [(a, b, order) for a, b in _spans(rule, pattern, text)]
    out: list[tuple[int, int, int]] = []
    for a, b, order in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), min(order, out[-1][2]))
        else:
            out.append((a, b, order))
    return [(a, b, RULES[order][0]) for a, b, order in out]


_NAME, _DIGIT, _SPACE = re.compile(NAMES, re.I), re.compile("[0-9]"), re.compile(r"\s+")
_COMPILED: list[tuple[str, tuple[str, ...], re.Pattern]] = []


def _compiled() -> list[tuple[str, tuple[str, ...], re.Pattern]]:
    if not _COMPILED:
        _COMPILED.extend((k, held, re.compile(p)) for k, held, p in RULES)
    return _COMPILED


def neighbours(text: str, spans: list[tuple[int, int]]) -> Iterator[tuple[str, str]]:
    """Left and right context of every span: ``CONTEXT`` characters, and the rest of the words that they cut."""
    gaps = [m.span() for m in _SPACE.finditer(text)]
    first, last = [a for a, _ in gaps], [b for _, b in gaps]
    for s, e in spans:
        a, b = max(0, s - CONTEXT), min(len(text), e + CONTEXT)
        i = bisect_right(last, a)
        a = min(a, last[i - 1] if i else 0)
        j = bisect_left(first, b)
        yield text[a:s], text[e:first[j] if j < len(first) else len(text)]


FINDING = ("id string, t1 long, t2 long, start int, end int, rule string, value string, "
           + ", ".join(f"{c} double" for c in FEATURES))


def candidates(documents: DataFrame, features: Features, id_col: str = "doc_id", text_col: str = "text",
               path_col: str = "source") -> DataFrame:
    """Candidate findings of all texts with their features."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["id", "t1", "t2", "start", "end", "rule", "value", *FEATURES]
        for b in batches:
            rows = []
            for id_, t1, t2, text, path in b.itertuples(index=False):
                found = find_candidates(text)
                for (s, e, rule), (left, right) in zip(found, neighbours(text, [x[:2] for x in found]) if found else (), strict=True):
                    rows.append((id_, t1, t2, s, e, rule, text[s:e], *features.vector(text[s:e], left, right, path or "", rule)))
            yield pd.DataFrame(rows, columns=cols)
    t1, t2 = text_key(F.col(text_col))
    rows = documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), t1.alias("t1"), t2.alias("t2"), F.col(text_col).alias("text"),
        (F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in documents.columns else F.lit("")).alias("path"))
    return spread(rows).mapInPandas(run, FINDING)


def generated(seed: int, n: int, words: list[str]) -> list[tuple[str, str, str, str, int]]:
    """``n`` labelled findings (value, left, right, path, label): half secrets, half look-alikes."""
    rng = np.random.default_rng(seed)
    words = words or ["lorem", "ipsum", "dolor"]
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alnum = lower + lower.upper() + digits
    prose = lambda k: " ".join(words[int(i)] for i in rng.integers(0, len(words), k))
    joined = lambda k, sep: sep.join(words[int(i)] for i in rng.integers(0, len(words), k))
    names = ["token", "secret", "password", "api_key", "access_key", "auth_token", "client_secret", "passwd"]
    safe = ["commit", "sha256:", "md5", "checksum", "revision", "uuid", "etag", "build", "see", "file", "id", "version"]
    paths = ["src", "lib", "app", "main", "tests", "docs", "examples"]
    out = []
    for i in range(n):
        before, after, path = prose(4), prose(4), paths[int(rng.integers(0, len(paths)))]
        kind = int(rng.integers(0, 6))
        if i % 20 == 9:  # long secrets: one unbroken value, or a key block
            body = pick(alnum + "+/", int(rng.integers(200, 3000)))
            if kind < 3:
                block = "\n".join(body[k:k + 64] for k in range(0, len(body), 64))
                name = ["", "RSA ", "EC ", "OPENSSH "][int(rng.integers(0, 4))]
                out.append((f"-----BEGIN {name}PRIVATE KEY-----\n{block}\n-----END {name}PRIVATE KEY-----",
                            before + "\n", "\n" + after, path, 1))
            else:
                body = body if kind < 5 else pick("0123456789abcdef", len(body))
                out.append((body, before + " " + names[int(rng.integers(0, len(names)))] + ' = "', '" ' + after, path, 1))
        elif i % 20 == 8:  # long look-alikes: embedded data, joined words, digits
            size = int(rng.integers(200, 3000))
            value = (pick(alnum + "+/", size) if kind < 3 else pick(digits, size) if kind == 3
                     else joined(size // 6, "_") + pick(digits, 1))
            left = before + (" data:image/png;base64," if kind < 3 else " " + safe[int(rng.integers(0, len(safe)))] + " ")
            out.append((value, left, " " + after, path, 0))
        elif i % 20 == 7:  # pass phrases in quotes
            value = joined(int(rng.integers(3, 6)), " ") + " " + pick(digits, int(rng.integers(1, 4)))
            out.append((value, before + " " + ["password", "passwd", "secret", "pwd"][kind % 4] + ' = "', '" ' + after, path, 1))
        elif i % 20 == 6:  # sentences in quotes
            value = joined(int(rng.integers(6, 14)), " ")
            out.append((value, before + " " + names[int(rng.integers(0, len(names)))] + ': "', '" ' + after, path, 0))
        elif i % 2:
            value = [lambda: pick("0123456789abcdef", int(rng.choice([32, 40, 64]))),
                     lambda: "AKIA" + pick(lower.upper() + digits, 16), lambda: "ghp_" + pick(alnum, 36),
                     lambda: pick(alnum, int(rng.integers(16, 48))), lambda: pick(alnum + "+/", 40),
                     lambda: pick(alnum + "!@#%^&*", int(rng.integers(10, 20)))][kind]()
            quote = ['"', "'", ""][int(rng.integers(0, 3))]
            sep = [" = ", "=", ": ", ":"][int(rng.integers(0, 4))]
            left = before + " " + names[int(rng.integers(0, len(names)))] + sep + quote
            if kind in (1, 2) and rng.random() < 0.3:
                left = before + " "
            out.append((value, left, quote + " " + after, path, 1))
        else:
            value = [lambda: pick("0123456789abcdef", int(rng.choice([32, 40, 64]))),
                     lambda: joined(4, "_") + pick(digits, 1), lambda: joined(3, "-") + "-" + pick(digits, 2),
                     lambda: "your_" + joined(2, "_") + "_here", lambda: pick(digits, int(rng.integers(20, 30))),
                     lambda: joined(int(rng.integers(2, 4)), "")][kind]()
            left = before + " " + safe[int(rng.integers(0, len(safe)))] + " "
            if kind in (1, 2, 3, 5) and rng.random() < 0.5:
                left = before + " " + names[int(rng.integers(0, len(names)))] + " = "
            out.append((value, left, " " + after, path, 0))
    return out


def labelled_findings(spark: SparkSession, words: list[str], n: int = N_LABELLED, seed: int = 17) -> DataFrame:
    return spark.createDataFrame(generated(seed, n, words), "value string, left string, right string, path string, label int")


def _rule_of(value: str) -> str:
    """The rule that a bare value would be found by (assignment needs its name, so not that one)."""
    for rule, _, pattern in _compiled():
        if rule != "assigned" and pattern.fullmatch(value) and (rule != "token" or _DIGIT.search(value)):
            return rule
    return "assigned"


def train(labelled: DataFrame, features: Features, trees: int = 40, depth: int = 8, seed: int = 7):
    """Random forest from labelled findings; at most ``N_LABELLED`` rows of the default table."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [features.vector(v, a, z, p, _rule_of(v)) for v, a, z, p in
                 zip(b["value"], b["left"], b["right"], b["path"], strict=True)]
            yield pd.DataFrame([[*r, float(y)] for r, y in zip(x, b["label"], strict=True)], columns=[*FEATURES, "label"])
    rows = materialise(labelled.select("value", "left", "right", "path", "label").mapInPandas(
        run, ", ".join(f"{c} double" for c in [*FEATURES, "label"])))
    vec = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label").fit(vec)


def scan(documents: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """(id, t1, t2, start, end, rule, value, probability, is_secret) of every candidate."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    spark = documents.sparkSession
    words = frequent_words(documents, text_col)
    features = Features(transition_counts(documents, text_col), words)
    model = train(labelled if labelled is not None else labelled_findings(spark, words), features)
    found = materialise(candidates(documents, features, id_col, text_col, path_col))
    vec = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    p = vector_to_array(F.col("probability"))[1]
    return (model.transform(vec).select("id", "t1", "t2", "start", "end", "rule", "value",
                                        F.round(p, 6).alias("probability"))
            .withColumn("is_secret", F.col("probability") >= threshold))


def redacted(text: Column, spans: Column, placeholder: str = PLACEHOLDER) -> Column:
    """``text`` with every (start, end) of the sorted ``spans`` replaced."""
    done = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(placeholder)).alias("out"),
            s["end"].alias("at")))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))


def redact(documents: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
           path_col: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with every secret replaced by ``PLACEHOLDER``; no document goes."""
    hits = (scan(documents, labelled, id_col, text_col, path_col, threshold).where("is_secret")
            .groupBy("id", "t1", "t2").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
            .withColumnsRenamed({"id": "_id", "t1": "_t1", "t2": "_t2"}))
    row = F.col("_row")
    k1, k2 = text_key(row[text_col])
    joined = as_row(documents).withColumns({"_k1": k1, "_k2": k2}).join(
        hits, row[id_col].cast("string").eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_t1"))
        & (F.col("_k2") == F.col("_t2")), "left")
    new = F.when(F.col("_spans").isNotNull(), redacted(row[text_col], F.col("_spans"))).otherwise(row[text_col])
    return from_row(joined, documents.columns, {text_col: new})
