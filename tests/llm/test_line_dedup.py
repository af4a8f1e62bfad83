import hashlib
import random
from collections import defaultdict

from graphweave.llm import line_dedup

from .conftest import ODD

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(i)
    keeper = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(v) >= 5}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_equals_brute_force(make_docs):
    rnd = random.Random(3)
    pool = [f"  This shared line number {i} has well over forty characters\t" for i in range(6)]
    pool += [pool[0].upper().strip(), "É" + "a" * 39, "é" + "a" * 39, "x" * 39, "x" * 40]
    rows = list(ODD)
    for i in range(10, 50):
        rows.append((i, "\n".join(rnd.choice(pool + [f"own {rnd.random()}", ""]) for _ in range(rnd.randrange(0, 9))), "en", "s"))
    df = make_docs(rows)
    out = line_dedup.dedup_lines(df, counts=("lines_before", "lines_gone"))
    assert out.columns == [*df.columns, "lines_before", "lines_gone"]
    got = sorted(((r["doc_id"], r["lines_before"], r["lines_gone"], r["text"]) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert any(g[2] for g in got)


def test_empty_table(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


def test_one_line_in_all_documents_stays_in_the_largest(make_docs):
    line = "this very line is held by every document of the table"
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(make_docs(
        [(i, f"a{i}\n{line}\n{line}", "en", "s") for i in range(300)])).collect()}
    assert out[299] == f"a299\n{line}\n{line}" and all(out[i] == f"a{i}" for i in range(299))
    assert hashlib.sha256(out[0].encode()).hexdigest()
