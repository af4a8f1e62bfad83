import random

import zlib

from graphweave.llm import sharding
from graphweave.llm.common import materialise

from .conftest import ODD, words


def place(spark, df, n):
    slotted = materialise(sharding.with_slots(df))
    sums = sharding.slot_sums(slotted)
    slots = sharding.build_map(sums, n)
    return sharding.assign(slotted, sharding.map_table(spark, slots, sums, 1)).collect(), sums, slots


def test_shards_are_near_equal_and_gapless(spark, make_docs):
    rows = [*ODD, *((100 + i, words(1 + i % 60, i), "en", "s") for i in range(1500))]
    out, _, _ = place(spark, make_docs(rows), 24)
    got = sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out)
    assert got == sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    load = {}
    for r in out:
        load.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    for s in load.values():
        assert sorted(x for x, _ in s) == list(range(len(s)))
    small = sorted(sum(b for _, b in s) for s in load.values())
    assert set(load) == set(range(24)) and small[-2] - small[0] < 0.03 * small[0]  # one shard has the long text


def test_empty_table(spark, make_docs):
    assert place(spark, make_docs([]), 24)[0] == []


def test_edited_map_moves_few_slots(spark, tmp_path):
    sums = [(s, 10, 1000 + s % 7) for s in range(4096)]
    first = sharding.build_map(sums, 24)
    grown = sharding.edit_map(first, sums, 25)
    moved = [s for s in first if first[s] != grown[s]]
    assert all(grown[s] == 24 for s in moved) and abs(len(moved) - 4096 / 25) < 12
    shrunk = sharding.edit_map(grown, sums, 24)
    assert set(shrunk.values()) == set(range(24))
    assert all(grown[s] == 24 for s in grown if grown[s] != shrunk[s] and grown[s] >= 24)
    heavier = [(s, n, b * 20 if s < 100 else b) for s, n, b in sums]
    balanced = sharding.edit_map(first, heavier, 24)
    load = [sum(b for s, _, b in heavier if balanced[s] == k) for k in range(24)]
    assert max(load) < 1.02 * min(load)
    assert sharding.edit_map(first, sums, 24) == first
    for v, m in enumerate([first, grown], 1):
        sharding.save_map(sharding.map_table(spark, m, sums, v), f"{tmp_path}/maps")
    assert sharding.load_map(spark, f"{tmp_path}/maps", 1) == first
    assert sharding.load_map(spark, f"{tmp_path}/maps", 2) == grown


def test_stored_versions_are_edited_and_read_again(spark, tmp_path):
    rnd = random.Random(4)
    sums = [(s, rnd.randrange(9), rnd.randrange(2000)) for s in range(400)]
    path = str(tmp_path / "map")
    first = sharding.rebalanced(spark, path, sums, 6)
    assert {r["version"] for r in first.select("version").distinct().collect()} == {2}
    assert sharding.last_version(spark, path) == 2
    grown = sharding.rebalanced(spark, path, sums, 7)
    old, new = sharding.load_map(spark, path, 2), sharding.load_map(spark, path, 3)
    assert {r["v_slot"]: r["shard"] for r in grown.collect()} == new
    assert sum(new[s] != old[s] for s in old) < 2 * 400 / 7    # most slots stay
    size = {s: b for s, _, b in sums}
    load = [sum(size[s] for s, x in new.items() if x == k) for k in range(7)]
    assert max(load) - min(load) <= 0.02 * sum(load) / 7
