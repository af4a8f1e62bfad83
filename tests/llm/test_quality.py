import random
import re

from graphweave.llm import quality

from .conftest import ODD


def numbers(text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    seen, again = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            again.update(k for i in at for k in range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again))


def test_numbers_equal_brute_force(make_docs):
    rnd = random.Random(5)
    rows = list(ODD)
    for i in range(20, 90):
        rows.append((i, "".join(rnd.choice(["a ", "b ", "é\t", "##", "\n", "x|y ", "\x0c", "line of its own\n", " ", "long" * 9])
                                for _ in range(rnd.randrange(0, 120))), "en", "s"))
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in quality.verdicts(make_docs(rows)).collect()), key=str)
    assert got == sorted(((i, *numbers(t)) for i, t, *_ in rows), key=str)


def test_adaptive_thresholds_follow_language_and_source(make_docs):
    rnd = random.Random(6)
    prose = lambda n, k: " ".join("".join(rnd.choice("abcdefgh") for _ in range(k)) for _ in range(n))
    rows = [(i, prose(60, 5), "en", "news") for i in range(300)]
    rows += [(1000 + i, prose(60, 5).replace(" ", " | ", 20), "en", "tables") for i in range(300)]
    rows += [(5000, prose(60, 5).replace(" ", " ### "), "en", "news"), (5001, prose(60, 14), "en", "news"),
             (5002, prose(60, 5), None, None), (5004, prose(60, 5).replace(" ", "!! "), "en", "news"),
             (5005, " ".join(w for w in prose(12, 5).split() for _ in range(6)), "en", "news"), (5003, prose(30, 6) + "\nsame\nsame\nsame\nsame\nsame\nsame", "en", "news")]
    out = {r["doc_id"]: r for r in quality.verdicts(make_docs(rows)).collect()}
    assert all(out[i]["kept"] for i in range(300))
    assert not out[5000]["kept"] and not out[5001]["kept"] and out[5002]["kept"] and not out[5003]["kept"]
    assert not out[5004]["kept"] and not out[5005]["kept"] and not out[5005]["base_failed"]
    assert out[1000]["max_symbols"] != out[0]["max_symbols"]


def test_filter_keeps_columns_and_rows(make_docs):
    text = " ".join(f"word{i}" for i in range(40))
    df = make_docs([*ODD, (50, text, "en", "a"), (50, text, "en", "a")])
    out = quality.filter_documents(df)
    assert out.columns == df.columns
    assert [r["doc_id"] for r in out.collect()] == [50, 50]
    assert quality.filter_documents(make_docs([])).count() == 0


def test_a_junk_source_with_a_third_of_all_rows_is_rejected(make_docs):
    rnd = random.Random(8)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    rows = [(i, prose(60), "en", f"clean{i % 3}") for i in range(600)]
    rows += [(1000 + i, prose(60).replace(" ", " | ", 18), "en", "junk") for i in range(300)]
    kept = {r["doc_id"] for r in quality.verdicts(make_docs(rows)).where("kept").collect()}
    assert kept == set(range(600))


def test_thresholds_move_smoothly_with_the_size_of_a_group(make_docs):
    rnd = random.Random(9)
    prose = lambda n, k: " ".join("".join(rnd.choice("abcdefgh") for _ in range(k)) for _ in range(n))
    wide = [(i, prose(60, 4 + i % 5), "de", "other") for i in range(400)]
    limit = []
    for size in (199, 200, 201):
        rows = wide + [(1000 + i, prose(60, 9), "en", "small") for i in range(size)]
        limit.append(next(r["max_length"] for r in quality.verdicts(make_docs(rows)).collect() if r["doc_id"] == 1000))
    assert max(limit) - min(limit) <= 4
