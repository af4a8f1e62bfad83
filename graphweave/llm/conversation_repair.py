"""Conversation structure repair.

The rows of a conversation, by turn, are mended with as little cost as possible so that the initials of their roles read
``(s?(ua)+)?``: nothing, or an optional system row and then user and assistant in turn.  Edits: Keep (0), Rerole to user
or assistant (3), Delete (4; required for blank and duplicate rows), Insert a user or assistant row with empty text
anywhere (3); a truncated row that is not deleted adds 3.  The audit is the string of the edits' initials in order.

Every choice is an ordinary integer minimum over a directed acyclic graph.  Its nodes are (rows read, state), the state
being what the roles so far end with; the weight of a path is one big integer, whose high digits are its cost and whose low
digits, of fixed width and fixed places, are its audit letters (D < I < K < R; unused places at the end are zero).  The
smaller integer is the cheaper path, and of equally cheap ones that with the ASCII-least audit.  From every state a letter
leads to one state only, so equal audits are equal paths.

A conversation may be of any length, so it is never held by one task while it is decided:

1. Rows (with hashes in place of texts) are range-partitioned and numbered in order; blocks of ``BLOCK`` numbers hold
   segments of conversations.
2. Each segment gives the best path from every state to every state (``segment_paths``).
3. Per conversation, a second graph over its segments chooses one of those paths each (``choose``); the digits of its
   weights are the ranks of the segments' audits, which compare as the audits do.
4. The chosen edits meet the rows of the conversation in order; the rows stream through a task in batches (a digest of the
   whole repaired text is sequential by nature; memory stays at a batch and the edits).

Defined results: a null role or text is one space; an empty role has no initial; a null conv_id is a conversation of its
own; null turns come first; rows of one turn follow each other by role, then text (their first 64 characters, then a hash of
both), equal rows being interchangeable and each after the first a duplicate; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphweave.llm.common import WS, materialise

BLOCK = 256
# Costs of the edits, and the roles of inserted and reroled rows.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LETTERS = "DIKR"            # audit letters in ASCII order: digits 1 to 4
DIGIT = {x: i + 1 for i, x in enumerate(LETTERS)}
BITS = 3
# States: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
STATE = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
CLOSING = {START: "", AFTER_A: "", AFTER_U: "a", AFTER_S: "ua"}
# Operations name the edit and its role: K, D, U and A (rerole), u and a (insert).
AUDIT = str.maketrans("UAua", "RRII")
ONE_ROW = re.compile("[ua]*[KDUA]")


def _row_edits(state: int, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[int, str, int]]:
    """(cost, operations, next state) for one row, with at most two rows inserted before it.

    A third insertion leads back to a state already reached for less.
    """
    cost, inserted = 0, ""
    for _ in range(3):
        if not must_go:
            more = TRUNCATED if truncated else 0
            if initial == NEXT[state] or (initial == "s" and state == START):
                yield cost + more, inserted + "K", STATE[initial]
            yield cost + more + REROLE, inserted + NEXT[state].upper(), STATE[NEXT[state]]
        yield cost + DELETE, inserted + "D", state
        cost, inserted, state = cost + INSERT, inserted + NEXT[state], STATE[NEXT[state]]


def segment_paths(rows: list[tuple[str, bool, bool]], starts: Iterable[int] = range(4)) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, operations) of the least weight for all pairs of states that a path joins.

    ``rows`` are (initial, must go, truncated); ``starts`` are the states they may be reached in.
    """
    width = 3 * len(rows)                      # letters at most: two insertions and an edit per row
    cost_at = BITS * width
    out = []
    for first in starts:
        best: dict[int, tuple[int, str]] = {first: (0, "")}
        for row in rows:
            found: dict[int, tuple[int, str]] = {}
            for state, (weight, ops) in best.items():
                for cost, more, to in _row_edits(state, *row):
                    w = weight + (cost << cost_at)
                    for k, letter in enumerate(more.translate(AUDIT), start=len(ops) + 1):
                        w += DIGIT[letter] << (cost_at - BITS * k)
                    if to not in found or w < found[to][0]:
                        found[to] = (w, ops + more)
            best = found
        out += [(first, to, w >> cost_at, ops) for to, (w, ops) in sorted(best.items())]
    return out


def choose(segments: list[list[tuple[int, int, int, int]]]) -> tuple[list[tuple[int, int]], int, str]:
    """The chosen (from, to) of every segment, the whole cost and the closing insertions.

    ``segments`` hold (from state, to state, cost, rank of the audit among the segment's audits).
    """
    bits = 5                                   # at most 16 paths a segment: ranks 1 to 16
    places = len(segments) + 1
    cost_at = bits * places
    best: dict[int, int] = {START: 0}
    steps: list[dict[int, int]] = []           # from which state each state was reached
    for k, paths in enumerate(segments, start=1):
        found: dict[int, int] = {}
        came: dict[int, int] = {}
        for a, b, cost, rank in paths:
            if a in best:
                w = best[a] + (cost << cost_at) + (rank << (cost_at - bits * k))
                if b not in found or w < found[b]:
                    found[b], came[b] = w, a
        best = found
        steps.append(came)
    weights = {s: w + (INSERT * len(CLOSING[s]) << cost_at) + len(CLOSING[s]) for s, w in best.items()}
    end = min(weights, key=weights.__getitem__)
    state, chosen = end, []
    for came in reversed(steps):
        chosen.append((came[state], state))
        state = came[state]
    return chosen[::-1], weights[end] >> cost_at, CLOSING[end]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32(``conv_id:turn``) % 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    d = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), d.alias("d")).where("d <> 0")
    text = F.when(F.col("d") == 1, F.lit("")).when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("d") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _keyed(conversations: DataFrame) -> DataFrame:
    """Rows with their conversation key and the keys of their order."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.select(
        "*", F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")).alias("ck"),
        F.substring("role", 1, 64).alias("o1"), F.substring("text", 1, 64).alias("o2"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"))


_ORDER = ["ck", "turn", "o1", "o2", "h1", "h2"]
_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _order() -> list[Column]:
    return [F.asc_nulls_first(c) for c in _ORDER]


def numbered_rows(conversations: DataFrame) -> DataFrame:
    """(ck, m, block, turn, initial, blank, duplicate, truncated) of all rows; ``m`` rises along every conversation."""
    bare = F.rtrim(F.col("text"), F.lit(WS))
    light = _keyed(conversations).select(
        *_ORDER, F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        ((bare != "") & ~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.monotonically_increasing_id().alias("uid"))
    order = [*_order(), F.asc("uid")]           # uid: many equal rows don't land in one range
    rows = materialise(light.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("m", F.monotonically_increasing_id()).drop("o1", "o2", "uid"))
    first = rows.groupBy("ck", "h1", "h2").agg(F.min("m").alias("m")).select("m", F.lit(False).alias("again"))
    return rows.join(first, "m", "left").select(
        "ck", "m", F.floor(F.col("m") / BLOCK).alias("block"), "turn", "initial", "blank",
        (~F.col("blank") & F.coalesce("again", F.lit(True))).alias("duplicate"), "truncated")


_PATH = "struct<a:int,b:int,cost:long,rank:int,ops:string>"
_SEGMENT = ("ck string, block long, n long, blank long, duplicate long, truncated long, illegal long, initials string, "
            f"turns long, turn_lo long, turn_hi long, paths array<{_PATH}>")
LEGAL = {"su", "ua", "au"}


def _segment(rows: list, starts: Iterable[int]) -> dict:
    """One segment: counts, what its neighbours need to know, and its paths."""
    facts, blank, duplicate, truncated, illegal = [], 0, 0, 0, 0
    for r in rows:
        cut = r.truncated and not r.duplicate
        blank, duplicate, truncated = blank + r.blank, duplicate + r.duplicate, truncated + cut
        facts.append((r.initial, r.blank or r.duplicate, cut))
    for x, y in zip(facts, facts[1:], strict=False):
        illegal += x[0] + y[0] not in LEGAL
    turns = sorted({int(r.turn) for r in rows if r.turn is not None})
    paths = segment_paths(facts, starts)
    ranks = {a: i for i, a in enumerate(sorted({p[3].translate(AUDIT) for p in paths}), start=1)}
    return {"ck": rows[0].ck, "block": rows[0].block, "n": len(rows), "blank": blank, "duplicate": duplicate,
            "truncated": truncated, "illegal": illegal, "initials": (rows[0].initial or " ") + (rows[-1].initial or " "),
            "turns": len(turns), "turn_lo": turns[0] if turns else None, "turn_hi": turns[-1] if turns else None,
            "paths": [(*p[:3], ranks[p[3].translate(AUDIT)], p[3]) for p in paths]}


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[list]:
    """Runs of rows with equal keys, across batches (the rows are sorted by them)."""
    held: list = []
    at = None
    for b in batches:
        b = b.astype(object).where(b.notna(), None)
        for r in b.itertuples(index=False):
            now = tuple(getattr(r, k) for k in key)
            if held and now != at:
                yield held
                held = []
            at = now
            held.append(r)
    if held:
        yield held


def segments(rows: DataFrame) -> DataFrame:
    """Segments of conversations (at most ``BLOCK`` rows each) with their paths, stored.

    Only the first segment of a block can continue a conversation of the block before; the others start one.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, block = [], None
        for held in _runs(batches, ["ck", "block"]):
            out.append(_segment(held, range(4) if held[0].block != block else [START]))
            block = held[0].block
            if len(out) >= 1000:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)
    # a number of its own: few bytes, but work for every core
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(rows.repartition(n, "block").sortWithinPartitions("m").mapInPandas(run, _SEGMENT))


def _frame(out: list[dict]) -> pd.DataFrame:
    df = pd.DataFrame(out)
    for c in ("turn_lo", "turn_hi"):
        df[c] = df[c].astype("Int64")
    return df


_CHOSEN = ("ck string, block long, a int, b int, closing string, blank long, duplicate long, truncated long, "
           "illegal long, cost long, gaps long")


def _decide(segs: list) -> list[tuple]:
    """Rows of ``_CHOSEN`` for the segments of one conversation, in order; the facts stand on the last one."""
    chosen, cost, closing = choose([[(p["a"], p["b"], p["cost"], p["rank"]) for p in s.paths] for s in segs])
    illegal = sum(s.illegal for s in segs) + sum(
        (x.initials[1] + y.initials[0]) not in LEGAL for x, y in zip(segs, segs[1:], strict=False))
    known = [s for s in segs if s.turns]
    turns = sum(s.turns for s in known) - sum(
        x.turn_hi == y.turn_lo for x, y in zip(known, known[1:], strict=False))
    gaps = int(known[-1].turn_hi) - int(known[0].turn_lo) + 1 - turns if known else 0
    rows = [(s.ck, s.block, a, b, "", *[None] * 6) for s, (a, b) in zip(segs, chosen, strict=True)]
    rows[-1] = (*rows[-1][:4], closing, sum(s.blank for s in segs), sum(s.duplicate for s in segs),
                sum(s.truncated for s in segs), illegal, cost, gaps)
    return rows


def decisions(segs: DataFrame) -> DataFrame:
    """(ck, block, ops, closing, facts...): the operations chosen for every segment."""
    names = [x.split()[0] for x in _CHOSEN.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for held in _runs(batches, ["ck"]):
            out += _decide(held)
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=names).astype({x: "Int64" for x in names[5:]})
                out = []
        if out:
            yield pd.DataFrame(out, columns=names).astype({x: "Int64" for x in names[5:]})

    # without the operations: a few numbers per segment
    lean = segs.withColumn("paths", F.transform("paths", lambda p: F.struct(
        p["a"].alias("a"), p["b"].alias("b"), p["cost"].alias("cost"), p["rank"].alias("rank"))))
    chosen = lean.repartition("ck").sortWithinPartitions("ck", "block").mapInPandas(run, _CHOSEN)
    ops = segs.select("ck", "block", F.explode("paths").alias("p")).select(
        "ck", "block", F.col("p.a").alias("a"), F.col("p.b").alias("b"), F.col("p.ops").alias("ops"))
    return chosen.join(ops, ["ck", "block", "a", "b"]).drop("a", "b")


def _edited(conversations: DataFrame) -> DataFrame:
    """Operations and rows of every conversation in one stream: first its segments' operations, then its rows, in order."""
    chosen = decisions(segments(numbered_rows(conversations)))
    nothing = [F.lit(None).cast("long").alias(c) for c in _FACTS]
    text = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    head = chosen.select("ck", F.lit(0).alias("kind"), F.col("block").alias("turn"), *[F.lit("").alias(c) for c in ("o1", "o2")],
                         *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2")], F.concat("ops", "closing").alias("ops"),
                         *_FACTS, *text)
    rows = _keyed(conversations).select(*_ORDER[:1], F.lit(1).alias("kind"), *_ORDER[1:], F.lit(None).cast("string").alias("ops"),
                                        *nothing, "role", "text")
    return (head.unionByName(rows).repartition("ck")
            .sortWithinPartitions("ck", "kind", *[F.asc_nulls_first(c) for c in _ORDER[1:]])
            .select("ck", "kind", "ops", "role", "text", *_FACTS))


def _events(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Walks the sorted rows of ``_edited``: (ck, role, text, edit) for every repaired row, then (ck, None, audit, facts)."""
    ck, ops, facts, edits, pieces = None, "", None, None, []

    def closing() -> Iterator[tuple]:
        for x in ops[len(ops.rstrip("ua")):]:
            yield ck, ROLES[x], "", "I"
        yield ck, None, ops.translate(AUDIT), facts

    for b in batches:
        for r in b.astype(object).where(b.notna(), None).itertuples(index=False):
            if r.ck != ck:
                if ck is not None:
                    yield from closing()
                ck, facts, edits, pieces = r.ck, None, None, []
            if r.kind == 0:
                pieces.append(r.ops)
                facts = facts if r.cost is None else [int(getattr(r, c)) for c in _FACTS]
                continue
            if edits is None:
                ops = "".join(pieces)
                edits = ONE_ROW.finditer(ops)
            step = next(edits).group()
            for x in step[:-1]:
                yield ck, ROLES[x], "", "I"
            if step[-1] == "K":
                yield ck, r.role, r.text, "K"
            elif step[-1] != "D":
                yield ck, ROLES[step[-1].lower()], r.text, "R"
    if ck is not None:
        yield from closing()


def _batched(rows: Iterator[tuple], columns: list[str], size: int = 1000) -> Iterator[pd.DataFrame]:
    out = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield pd.DataFrame(out, columns=columns)
            out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    sha, start = hashlib.sha256(), True
    for ck, role, text, last in _events(batches):
        if role is None:
            yield ck, *last, text, sha.hexdigest()
            sha, start = hashlib.sha256(), True
        else:
            sha.update((("" if start else "\n") + role + ":" + text).encode())
            start = False


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    at, n = None, 0
    for ck, role, text, last in _events(batches):
        if role is not None:
            n = n + 1 if ck == at else 0
            at = ck
            yield ck, n, role, text, last


def _conv_id(conversations: DataFrame) -> Column:
    """conv_id again from its key."""
    return F.when(F.col("ck") == "n", F.lit(None)).otherwise(F.substr("ck", F.lit(2))).cast(
        conversations.schema["conv_id"].dataType).alias("conv_id")


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit) of the repaired conversations; ``edit`` is K, R or I."""
    columns = ["ck", "position", "role", "text", "edit"]
    out = _edited(conversations).mapInPandas(lambda it: _batched(_lines(it), columns),
                                             "ck string, position long, role string, text string, edit string")
    return out.select(_conv_id(conversations), *columns[1:])


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    columns = ["ck", *_FACTS, "audit", "repaired_sha256"]
    out = _edited(conversations).mapInPandas(lambda it: _batched(_digests(it), columns), ", ".join(
        ["ck string", *[f"{c} long" for c in _FACTS], "audit string", "repaired_sha256 string"]))
    return out.select(_conv_id(conversations), *columns[1:])


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every original conv_id (zeros and empty where no row is left)."""
    ids = conversations.select(F.col("conv_id").alias("i")).distinct()
    out = repair(damage(conversations))
    both = ids.join(out, F.col("i").eqNullSafe(F.col("conv_id")), "left")
    empty = F.sha2(F.lit(""), 256)
    return both.select(F.col("i").alias("conv_id"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in _FACTS],
                       F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
