"""Many phrases against many texts: exact occurrence and partial ratio.

Both walk each text once for all phrases of a block: occurrences with an Aho-Corasick automaton, partial ratios with a bit-parallel
sieve and shared three-grams that leave few windows to score (``functions.fuzzy.PartialScan``).  A dictionary that
passes the check of rows and bytes is one block and is broadcast; texts don't move.  A larger one is dealt into blocks by
hash, texts into cells, and every (block, cell) is one group of bounded size, so neither side has to fit a task or the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fits_broadcast, stored

# A block of phrases holds about this many rows and bytes at most; a cell of texts this many bytes.
BLOCK_MAX_ROWS = 2_000
BLOCK_MAX_BYTES = 4 << 20
CELL_BYTES = 32 << 20
# An automaton walks a text as fast for many phrases as for few: only their bytes bound it.
AUTOMATON_MAX_ROWS = 200_000

Matcher = Callable[[list[str]], Iterable[tuple]]
Builder = Callable[[list[str]], Matcher]

_built: dict = {}


def _matcher(key, rows: list[tuple], build: Builder) -> tuple[list, Matcher]:
    """Matcher of a block, built once per Python worker and block (the last one is kept)."""
    if key not in _built:
        _built.clear()
        _built[key] = ([r[0] for r in rows], build([r[1] for r in rows]))
    return _built[key]


def _found(ids: list, match: Matcher, entities: list, texts: list[str]) -> list[tuple]:
    return [(entities[i], ids[k], *more) for i, k, *more in match(texts)]


def match_all(entities: DataFrame, entity_id: str, text: str, phrases: DataFrame, phrase_id: str, phrase: str,
              build: Builder, more: str = "", max_rows: int | None = None, in_order: bool = False) -> DataFrame:
    """(entity_id, phrase_id, more...) for every text and match that ``build(phrases)`` gives for it.

    ``build`` makes, from a list of phrases, a function from a list of texts to rows (number of the text, number of the
    phrase, more...).  ``in_order``: the list is in the order of the (non-null) ``phrase_id``.
    """
    max_rows = BLOCK_MAX_ROWS if max_rows is None else max_rows
    types, ptypes = dict(entities.dtypes), dict(phrases.dtypes)
    schema = f"`{entity_id}` {types[entity_id]}, `{phrase_id}` {ptypes[phrase_id]}" + (f", {more}" if more else "")
    ent = entities.select(F.col(entity_id).alias("e"), F.col(text).alias("t")).where("t is not null")
    ph = phrases.select(F.col(phrase_id).alias("p"), F.col(phrase).alias("s")).where("s is not null")
    names = [entity_id, phrase_id, *[c.split()[0] for c in more.split(",") if c]]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names)

    if fits_broadcast(ph, max_rows, BLOCK_MAX_BYTES):
        rows = [tuple(r) for r in ph.collect()]
        held = entities.sparkSession.sparkContext.broadcast(sorted(rows) if in_order else rows)
        key = held._jbroadcast.id()

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, match = _matcher(key, held.value, build)
            for b in batches:
                rows = _found(ids, match, b["e"].tolist(), b["t"].tolist())
                if rows:
                    yield frame(rows)
        return ent.mapInPandas(scan, schema)

    ph = stored(ph)
    size = ph.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("s")).alias("b")).first()
    n_blocks = 1 + max(2 * size["n"] // max_rows if max_rows else 3, 2 * (size["b"] or 0) // BLOCK_MAX_BYTES)
    n_cells = 1 + (ent.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // CELL_BYTES
    place = lambda n: F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = ent.withColumn("cell", place(n_cells)).withColumn("block", every(n_blocks))
    right = ph.withColumn("block", F.pmod(F.xxhash64("s"), F.lit(n_blocks)).cast("int")).withColumn("cell", every(n_cells))

    def pair(texts: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(texts) or not len(mine):
            return frame([])
        if in_order:
            mine = mine.sort_values("p")
        match = build(mine["s"].tolist())
        return frame(_found(mine["p"].tolist(), match, texts["e"].tolist(), texts["t"].tolist()))

    return left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInPandas(pair, schema)


def _automaton(phrases: list[str]) -> Matcher:
    import ahocorasick

    at: dict[str, list[int]] = {}
    for k, s in enumerate(phrases):
        at.setdefault(s, []).append(k)
    if not at:
        return lambda texts: []
    machine = ahocorasick.Automaton()
    for s, ks in at.items():
        machine.add_word(s, ks)
    machine.make_automaton()

    def match(texts: list[str]) -> Iterator[tuple]:
        for i, t in enumerate(texts):
            for k in {k for _, ks in machine.iter(t) for k in ks}:
                yield i, k
    return match


def phrase_matches(entities: DataFrame, entity_id: str, text: str,
                   phrases: DataFrame, phrase_id: str, phrase: str) -> DataFrame:
    """(entity_id, phrase_id) where the non-empty ``phrase`` occurs in ``text``: one row per row of each side that match."""
    ph = phrases.select(phrase_id, phrase).where(F.length(phrase) > 0)
    return match_all(entities, entity_id, text, ph, phrase_id, phrase, _automaton)


def _least(phrases: list[str]) -> Matcher:
    import ahocorasick

    at: dict[str, int] = {}
    for k, s in enumerate(phrases):
        at.setdefault(s, k)
    if not at:
        return lambda texts: []
    machine = ahocorasick.Automaton()
    for s, k in at.items():
        machine.add_word(s, k)
    machine.make_automaton()

    def match(texts: list[str]) -> Iterator[tuple]:
        for i, t in enumerate(texts):
            least = len(phrases)
            for _, k in machine.iter(t):
                if k < least:
                    least = k
                    if not k:
                        break
            if least < len(phrases):
                yield i, least
    return match


def first_matches(entities: DataFrame, entity_id: str, text: str,
                  phrases: DataFrame, place: str, phrase: str) -> DataFrame:
    """(entity_id, place): for each text the least ``place`` of the non-empty phrases that occur in it, and none where none does.

    ``place`` is a number, never null.  A dictionary of several blocks gives a text one row for each block.
    """
    ph = phrases.select(place, phrase).where(F.length(phrase) > 0)
    return match_all(entities, entity_id, text, ph, place, phrase, _least, max_rows=AUTOMATON_MAX_ROWS, in_order=True)


def partial_matches(entities: DataFrame, entity_id: str, text: str,
                    phrases: DataFrame, phrase_id: str, phrase: str, threshold: int = 85) -> DataFrame:
    """(entity_id, phrase_id, score) with partial ratio >= threshold, for pairs that are *not* plain substring hits."""
    from ..functions.fuzzy import PartialScan

    cutoff = float(threshold)
    ph = phrases.select(phrase_id, phrase).where(F.length(phrase) > 0)
    return match_all(entities, entity_id, text, ph, phrase_id, phrase,
                     lambda held: PartialScan(held, cutoff).score, "score double")
