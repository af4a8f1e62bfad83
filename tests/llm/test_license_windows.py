import random
from collections import Counter

import pytest

from graphweave.llm import license_scan
from graphweave.llm.licence_texts import TEMPLATES

from .conftest import words

BODY = {t: b for t, _, b in TEMPLATES}


def test_notices_inside_long_documents(make_docs):
    gpl = BODY["gpl3-header"].replace("version. This", "version.\n\nThis").replace("details.", "details.\n")
    apache = BODY["apache2-header"].replace("License. You", "License.\nYou").replace("LICENSE-2.0 Unless", "LICENSE-2.0\n\nUnless")
    bsd = BODY["bsd3-text"].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ")
    notices = {"MIT": BODY["mit-text"], "GPL-3.0-or-later": gpl, "Apache-2.0": apache, "BSD-3-Clause": bsd}
    rows = []
    for i, body in enumerate(notices.values()):
        rows.append((i, words(300) + "\n\n" + body + "\n\n" + words(300, 1), "en", "s"))
        rows.append((10 + i, words(300) + " " + " ".join(body.split()) + " " + words(300, 1), "en", "s"))
    out = license_scan.scan(make_docs(rows)).where("kind = 'window'").collect()
    best = {r["doc_id"]: r for r in out if r["n_unit"] > 40}
    assert {i: r["spdx"] for i, r in best.items()} == {k + i: s for k in (0, 10) for i, s in enumerate(notices)}
    assert all(r["dice"] == pytest.approx(1.0) for r in best.values()) and best[0]["first_line"] == 2


def _units(text):
    """(kind, first line, last line, words) of lines, paragraphs and the whole text; and (word, line) of all words."""
    up = {c: " " for c in "©–—‘’“”"} | {chr(c): " " for c in range(128) if not (chr(c).isalnum() or c == 10)}
    norm = "".join(up.get(c, c.lower() if c.isascii() else c) for c in text)
    lines = [x.split() for x in norm.split("\n")]
    out = [("line", i, i, w) for i, w in enumerate(lines)]
    blocks, start = [], None
    for i, w in enumerate([*lines, []]):
        if w and start is None:
            start = i
        if not w and start is not None:
            blocks.append((start, i - 1))
            start = None
    flat = lambda a, b: [w for x in lines[a:b + 1] for w in x]
    out += [("paragraph", a, b, flat(a, b)) for a, b in blocks if b > a]
    if len(blocks) > 1:
        out.append(("text", blocks[0][0], blocks[-1][1], flat(0, len(lines))))
    return out, [(w, i) for i, x in enumerate(lines) for w in x]


def _shared(a, b):
    return sum((Counter(zip(a, a[1:], strict=False)) & Counter(zip(b, b[1:], strict=False))).values())


def _brute(text, templates):
    """Rows without id: units first, then windows by trying all of them, best ones first."""
    bodies = [(t, s, [w for w, _ in _units(b)[1]]) for t, s, b in templates]
    units, words = _units(text)
    out = []
    for kind, a, b, w in units:
        best = None
        for t, s, body in bodies:
            n, m = len(w) - 1, len(body) - 1
            if n > 0 and 120 * min(n, m) >= 80 * max(n, m) and 200 * (x := _shared(w, body)) >= 80 * (n + m):
                best = min(best or (1,), (-2 * x / (n + m), t, s, x, n, m))
        if best and best != (1,):
            out.append((kind, a, b, best[2], best[1], best[3], best[4], best[5]))
    found = []
    for t, s, body in bodies:
        m = len(body) - 1
        grams = set(zip(body, body[1:], strict=False))
        places = [i for i in range(len(words) - 1) if (words[i][0], words[i + 1][0]) in grams]
        for i in places:
            best = None
            for j in places:
                n = j - i + 1
                if i <= j and n <= 120 * m // 80:
                    run = [w for w, _ in words[i:j + 2]]
                    x = _shared(run, body)
                    if x == _shared(run[:-1], body):
                        continue                    # a window ends at a bigram that counts
                    line = sum(k == words[i][1] for _, k in words) - 1
                    own = words[i][1] == words[j + 1][1] and line <= m and 120 * line >= 80 * m
                    if 200 * x >= 80 * (n + m) and not own:
                        best = min(best or (1,), (-2 * x / (n + m), -n, t, i, j, s, x, m))
            if best and best != (1,):
                found.append(best)
    kept = []
    for w in sorted(found):
        if all(w[4] < k[3] or w[3] > k[4] for k in kept):
            kept.append(w)
    by_unit = [u[1:3] for u in out]
    for _, n, t, i, j, s, x, m in kept:
        a, b = words[i][1], words[j + 1][1]
        if not any(lo <= a and hi >= b for lo, hi in by_unit):
            out.append(("window", a, b, s, t, x, -n, m))
    return sorted(out)


def test_windows_equal_brute_force(spark, make_docs):
    rnd = random.Random(2)
    vocabulary = "permission granted software copy the of to any use sell".split()
    templates = [(f"t{k}", f"S{k}", " ".join(rnd.choice(vocabulary) for _ in range(n))) for k, n in enumerate((5, 9, 14, 14, 22))]
    templates.append(("t9", "S9", templates[2][2] + " the end"))       # nearly equal to another: ties and overlaps
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            body = rnd.choice(templates)[2].split()
            for _ in range(rnd.randint(0, 3)):
                body[rnd.randrange(len(body))] = rnd.choice(["odd", "word", *vocabulary])
            parts.append(rnd.choice([" ", "\n", "\n\n", " x y "]).join(
                [" ".join(body[:4]), " ".join(body[4:])]) + rnd.choice(["", "\n", " some filler words here ", "\n\n"]))
        rows.append((i, " ".join(parts), "en", "s"))
    rows += [(100, templates[1][2] + "\n" + templates[1][2], "en", "s"), (100, rows[0][1], "en", "s"), (0, rows[0][1], "en", "s")]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "\n\n", "en", "s"), (203, (templates[3][2] + " ") * 50, "en", "s")]
    got = Counter(tuple(r)[:9] for r in license_scan.scan(make_docs(rows), templates=templates).collect())
    want = Counter((i, *x) for i, t in {(r[0], r[1]) for r in rows if r[1] is not None} for x in _brute(t, templates))
    assert got == want and sum(k[1] == "window" for k in want) > 20


def test_neighbouring_notices_in_one_line(make_docs):
    mit = " ".join(BODY["mit-text"].split())
    changed = mit.split()
    for i in range(5, 165, 20):
        changed[i] = f"changed{i}"
    rows = [(1, mit + " " + " ".join(changed), "en", "s"), (2, " ".join([mit] * 40), "en", "s"),
            (3, words(40) + " " + " ".join(changed) + " " + words(40, 1), "en", "s")]
    got = Counter((r["doc_id"], r["kind"], r["shared"]) for r in license_scan.scan(make_docs(rows)).collect())
    assert got == {(1, "window", 162): 1, (1, "window", 146): 1, (2, "window", 162): 40, (3, "window", 146): 1}
