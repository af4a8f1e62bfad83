"""Conversation repair against an exhaustive search."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from graphweave.llm import conversation_repair as repair

WS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else "".join(x for x in text if x not in ".!?") if d == 2 else text
        out += [(c, t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def best_edits(rows):
    """(cost, audit, lines) by trying everything; ``rows`` are (role, text, must go, truncated)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def go(i, q, inserted):
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []

        def step(cost, letter, line, rest):
            if rest is not None:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))
        if inserted < 2:
            step(3, "I", (repair.ROLES[after[q]] + ":",), go(i, after[q], inserted + 1))
        if i < len(rows):
            role, text, must, cut = rows[i]
            step(4, "D", (), go(i + 1, q, 0))
            if not must:
                if role[:1] == after[q] or (role[:1] == "s" and not q):
                    step(3 * cut, "K", (role + ":" + text,), go(i + 1, role[0], 0))
                step(3 + 3 * cut, "R", (repair.ROLES[after[q]] + ":" + text,), go(i + 1, after[q], 0))
        return min(found, default=None)
    return go(0, "", 0)


def summary(rows):
    """The result for one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, facts, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        bare = text.strip(WS)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        if fault:
            n[fault] += 1
        seen.add((role, text))
        facts.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, lines = best_edits(tuple(facts))
    return (gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def table(rng, n_conv, longest):
    out = []
    for c in range(n_conv):
        roles = rng.choice([["user", "assistant"], ["user", "assistant", "system", "tool", "", None, "ü"]])
        for t in range(rng.randint(1, longest)):
            text = rng.choice(["Fine.", "cut off", "Really?\n", " \t", "", None, f"Number {t}!", "é.\u00a0"])
            turn = None if rng.random() < 0.03 else t + rng.choice([0, 0, 0, 5])
            out.append((None if c == 3 else c, turn, roles[t % 2] if rng.random() < 0.7 else rng.choice(roles), text))
    return out


def check(spark, rows, block=None):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA + ", ck string, m int").repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_damaged(df).collect()}
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {c: summary(rs) for c, rs in by.items()}
    assert got == {c: w[0] for c, w in want.items()}
    lines = {}
    for r in repair.repaired_rows(repair.damage(df)).collect():
        lines.setdefault(r["conv_id"], []).append((r["position"], f"{r['role']}:{r['text']}"))
    assert {c: [x for _, x in sorted(v)] for c, v in lines.items()} == {c: list(w[1]) for c, w in want.items() if w[1]}


def test_equals_exhaustive_search(spark):
    check(spark, table(random.Random(5), 150, 12))


def test_conversations_over_many_blocks(spark, monkeypatch):
    """One conversation holds most rows and crosses block and range borders; another is one row repeated."""
    rng = random.Random(6)
    rows = table(rng, 20, 6)
    rows += [(77, t, rng.choice(["user", "assistant"]), f"row {t}" + rng.choice([".", ""])) for t in range(300)]
    rows += [(78, 1, "user", "the same.")] * 100
    check(spark, rows)
    monkeypatch.setattr(repair, "BLOCK", 4)
    check(spark, rows)


def test_segments_join_to_the_whole():
    """The choice over segments equals the paths of the rows in one piece."""
    rng = random.Random(7)
    for _ in range(300):
        rows = [(rng.choice("usat"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(2, 30))]
        cuts = [0, *sorted(rng.sample(range(1, len(rows)), rng.randint(0, min(4, len(rows) - 1)))), len(rows)]
        paths = [repair.segment_paths(rows[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

        def ranked(p):
            audits = sorted({x[3].translate(repair.AUDIT) for x in p})
            return [(*x[:3], audits.index(x[3].translate(repair.AUDIT)) + 1) for x in p]
        chosen, cost, closing = repair.choose([ranked(p) for p in paths])
        ops = "".join(next(x[3] for x in p if x[:2] == c) for p, c in zip(paths, chosen, strict=True)) + closing
        whole = best_edits(tuple(({"u": "user", "a": "assistant", "s": "system", "t": "tool"}[x], "", m, c) for x, m, c in rows))
        assert (cost, ops.translate(repair.AUDIT)) == whole[:2]


def test_empty_and_long(spark):
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "ok."), (2, 10**15, "user", "a."), (2, 3, "x" * 5000, "b.")])


@pytest.mark.parametrize("row", [(None, None, None, None)])
def test_all_null(spark, row):
    check(spark, [row, row])
