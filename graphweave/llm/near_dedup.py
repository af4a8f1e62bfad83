"""Near-duplicate components by SetSketch banding, joint estimation and exact verification.

1. Every text becomes its set of 5-word shingles; per document only the set
   size, a 128-bit fingerprint of the set and ``BANDS * ROWS`` SetSketch
   registers are stored.
2. Rows with equal sets are one class, whatever their ids; all later work is on classes, each with a number of
   its own, and on the text of one row (the smallest id, then text key) per class.
3. Registers are cut into bands; representatives that agree on a band share a
   bucket.  Each bucket names one leader (by a hash, so different bands have
   different leaders) and proposes only (leader, member) pairs: linear in the
   bucket, however large.
4. Proposed pairs pass the joint likelihood test on registers and exact set
   sizes, then are verified on the full sets, in blocks of one document and at most
   ``BLOCK`` partners.  Verified links are contracted to components.
5. Buckets that still hold several components are finished exactly, in cells: rows
   outside the bucket's main component meet every row of another component.  A
   first pass compares registers and names the rows that have a possible partner
   (less than 60 % equal registers cannot pass the likelihood test); a second one
   intersects the full sets of these rows and returns, per cell, only links that
   join two components.  The components are contracted again.

A pair at exactly the threshold misses all bands with probability
(1 - 0.85^5)^26 < 3e-7.  Nothing is capped: a bucket of any size is handled by
3 and 5, and no key, group or component is collected into one task.

Defined results: texts without words (or null) have an empty set, are linked with
nothing and stay; a null id is linked with nothing and stays; rows that repeat an id are judged by their own texts each
(rows of one id whose texts aren't linked can be in two components); ``keep_one`` keeps of every component the text with the
smallest id, then fingerprint, and of rows equal in id and text the one first in the order of its JSON; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphweave.llm import shingles as S
from graphweave.llm.common import as_row, from_row, materialise, spread, text_key

ROWS = 5
BANDS = 26
BLOCK = 64
CELL = 512
# Log-likelihood slack: about 5 standard errors of the estimate.
SLACK = 12.5
NUM, DEN = 85, 100


def sketch(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, n, f1, f2, regs): text key, set size, 128-bit set fingerprint, register bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        mul, add = S.seeds(ROWS * BANDS)
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                sets = S.shingle_sets(part["text"].tolist())
                fp = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "t1": part["t1"], "t2": part["t2"], "n": [len(x) for x in sets],
                    "f1": [int.from_bytes(x[:8], "little", signed=True) for x in fp],
                    "f2": [int.from_bytes(x[8:], "little", signed=True) for x in fp],
                    "regs": [S.registers(x, mul, add).tobytes() if len(x) else None for x in sets]})
    t1, t2 = text_key(F.coalesce(F.col(text_col), F.lit("")))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), t1.alias("t1"), t2.alias("t2"))
    rows = rows.where(F.col("doc_id").isNotNull())
    return spread(rows).mapInPandas(run, "doc_id long, t1 long, t2 long, n long, f1 long, f2 long, regs binary")


def classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set, stored: (rep, f1, f2, n, regs, of), where ``rep`` is the class' number and ``of`` the
    (doc_id, t1, t2) of the row whose text stands for it."""
    found = (sketches.where("n > 0").groupBy("f1", "f2")
             .agg(F.max("n").alias("n"), F.first("regs").alias("regs"), F.min(F.struct("doc_id", "t1", "t2")).alias("of")))
    return materialise(found.withColumn("rep", F.monotonically_increasing_id()))


def band_keys(reps: DataFrame) -> DataFrame:
    """(key, rep): a 64-bit key of every band of every representative."""
    band = F.col("band")
    width = 2 * ROWS
    return (reps.select("rep", "regs", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
            .select(F.xxhash64(band, F.substring(F.col("regs"), band * width + 1, F.lit(width))).alias("key"), "rep"))


def _plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose registers and sizes allow the threshold."""
    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    joined = (pairs.join(left, "a").join(right, "b")
              .where((DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p) == 0:
                continue
            ra = np.frombuffer(b"".join(p["ra"]), dtype="<u2").reshape(len(p), -1)
            rb = np.frombuffer(b"".join(p["rb"]), dtype="<u2").reshape(len(p), -1)
            ok = S.plausible(ra, rb, p["na"].to_numpy(float), p["nb"].to_numpy(float), NUM / DEN, SLACK)
            yield p.loc[ok, ["a", "b"]]
    return joined.mapInPandas(run, "a long, b long")


def _sets(documents: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc, elems): the full sets of the given classes (rep, of), stored.

    Texts move to the ids whatever their number (at scale they are never few).
    """
    t1, t2 = text_key(F.coalesce(F.col("text"), F.lit("")))
    mine = reps.select("rep", F.col("of.doc_id").alias("doc_id"), F.col("of.t1").alias("t1"), F.col("of.t2").alias("t2")).distinct()
    texts = (documents.withColumns({"t1": t1, "t2": t2}).join(mine.hint("merge"), ["doc_id", "t1", "t2"])
             .groupBy("doc_id", "t1", "t2", "rep").agg(F.first("text").alias("text")))  # placed by the join already

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                yield pd.DataFrame({"doc": part["rep"],
                                    "elems": [x.tobytes() for x in S.shingle_sets(part["text"].tolist())]})
    return materialise(texts.mapInPandas(run, "doc long, elems binary"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs confirmed on full sets.  ``pairs`` must be a stored table.

    The partners of one document are dealt into blocks of about ``BLOCK``; a
    block receives the sets of its members once each.
    """
    per = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = pairs.join(per, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("blk"))
    members = dealt.select("a", "blk", F.col("b").alias("doc")).unionByName(
        dealt.select("a", "blk", F.col("a").alias("doc")).distinct())

    def verify(key, block: pd.DataFrame) -> pd.DataFrame:
        a = key[0]
        held = {d: np.frombuffer(e, dtype=np.uint64) for d, e in zip(block["doc"], block["elems"], strict=True)}
        mine = held.get(a)
        hits = [d for d, x in held.items() if d != a and S.jaccard_at_least(mine, x, NUM, DEN)] if mine is not None else []
        return pd.DataFrame({"a": np.full(len(hits), a, dtype=np.int64), "b": np.array(hits, dtype=np.int64)})

    return members.join(sets, "doc").groupBy("a", "blk").applyInPandas(verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable, for every node of an edge.

    Alternating large-star and small-star contraction; each round is written to
    the shared folder.  Rounds grow with the logarithm of the longest chain.
    """
    cur = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct())
    seen = None
    two_ways = lambda a, b, c, d: F.explode(F.array(
        F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(c).alias("u"), F.col(d).alias("v")))).alias("e")
    while True:
        both = cur.select(two_ways("u", "v", "v", "u")).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(two_ways("u", "m", "v", "m")).select("e.*").where("u <> v").distinct()
        cur = materialise(small)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def _in_cells(held: DataFrame, payload: DataFrame, columns: list[str], schema: str, compare) -> DataFrame:
    """Run ``compare`` over the cells of every bucket of ``held`` (key, rep, root).

    A bucket's main component is its most frequent one.  Its other rows ("odd")
    and all its rows are cut into cells of about ``CELL`` rows; every odd cell meets
    every cell.  Buckets of equal content are worked on once.
    """
    per = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("h"))
    mixed = (per.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("h").alias("h"),
                                    F.sum("c").alias("total"), F.max("c").alias("most"), F.count(F.lit(1)).alias("k"))
             .where("k > 1"))
    once = mixed.groupBy("h", "total", "main", "most").agg(F.min("key").alias("key"))
    rows = materialise(held.join(once, "key").select(
        "key", "rep", "root", (F.col("root") != F.col("main")).alias("odd"),
        F.ceil((F.col("total") - F.col("most")) / CELL).cast("int").alias("odd_cells"),
        F.ceil(F.col("total") / CELL).cast("int").alias("all_cells")))
    cell = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    left = rows.where("odd").select(
        "key", cell(F.col("odd_cells")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_cells") - 1)).alias("j"),
        F.lit(True).alias("side"), "rep", "root")
    right = rows.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("odd_cells") - 1)).alias("i"), cell(F.col("all_cells")).alias("j"),
        F.lit(False).alias("side"), "rep", "root")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows arrive sorted by cell; the last cell of a batch may go on in the next one
        rest: pd.DataFrame | None = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            if len(b) == 0:
                continue
            k = b[["key", "i", "j"]].to_numpy()
            cuts = np.r_[np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)]), len(b)].tolist()
            rest = b.iloc[cuts[-2]:].reset_index(drop=True)
            if len(cuts) > 2:
                yield compare(b.iloc[:cuts[-2]], cuts[:-1])
        if rest is not None:
            yield compare(rest, [0, len(rest)])

    dealt = (left.unionByName(right).join(payload, "rep").select("key", "i", "j", "side", "rep", "root", *columns)
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    return dealt.mapInPandas(run, schema)


def _sides(rows: pd.DataFrame, cuts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per cell: positions of the odd rows, of all rows, and which pairs may be linked (other component, sizes)."""
    side, root, n = rows["side"].to_numpy(bool), rows["root"].to_numpy(), rows["n"].to_numpy(np.int64)
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        x, y = s + np.flatnonzero(side[s:e]), s + np.flatnonzero(~side[s:e])
        if len(x) and len(y):
            small, large = np.minimum(n[x][:, None], n[y][None, :]), np.maximum(n[x][:, None], n[y][None, :])
            may = (root[x][:, None] != root[y][None, :]) & (DEN * small >= NUM * large)
            if may.any():
                yield x, y, may


def _possible(rows: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
    """(key, rep) of the rows that have a partner whose registers allow the threshold."""
    regs = np.frombuffer(b"".join(rows["regs"]), dtype="<u2").reshape(len(rows), -1)
    # below this share of equal registers the likelihood test can't pass (see SLACK)
    least = int(0.6 * regs.shape[1])
    hit = np.zeros(len(rows), dtype=bool)
    for x, y, may in _sides(rows, cuts):
        step = max(1, (1 << 24) // (len(y) * regs.shape[1]))
        for at in range(0, len(x), step):
            u, m = x[at:at + step], may[at:at + step]
            if 4 * m.sum() > m.size:
                ok = m & ((regs[u][:, None, :] == regs[y][None, :, :]).sum(axis=2) >= least)
                i, j = np.nonzero(ok)
            else:
                i, j = np.nonzero(m)
                ok = (regs[u[i]] == regs[y[j]]).sum(axis=1) >= least
                i, j = i[ok], j[ok]
            hit[u[i]] = True
            hit[y[j]] = True
    out = rows.loc[hit, ["key", "rep"]]
    return out.drop_duplicates()


def _joining(rows: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
    """Per cell the verified links that join two components, as pairs of roots."""
    sets = [np.frombuffer(e, dtype=np.uint64) for e in rows["elems"]]
    root, n = rows["root"].to_numpy(), rows["n"].to_numpy(np.int64)
    out: list[tuple[int, int]] = []
    for x, y, may in _sides(rows, cuts):
        inter = _intersections([sets[i] for i in x], [sets[i] for i in y])
        union = n[x][:, None] + n[y][None, :] - inter
        i, j = np.nonzero(may & (DEN * inter >= NUM * union))
        up: dict[int, int] = {}

        def find(r: int, up: dict[int, int] = up) -> int:
            while r in up:
                r = up[r]
            return r
        for a, b in zip(root[x[i]].tolist(), root[y[j]].tolist(), strict=True):
            p, q = find(a), find(b)
            if p != q:
                up[max(p, q)] = min(p, q)
                out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _intersections(left: list[np.ndarray], right: list[np.ndarray], cells: int = 1 << 24) -> np.ndarray:
    """Sizes of all pairwise intersections: products of 0/1 columns, a slice of the elements at a time."""
    every = left + right
    who = np.repeat(np.arange(len(every)), [len(e) for e in every])
    elems, at, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    keep = count[at] > 1  # an element of one row alone adds nothing
    who, at = who[keep], at[keep]
    _, at = np.unique(at, return_inverse=True)
    order = np.argsort(at, kind="stable")
    who, at = who[order], at[order]
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    width = max(1, cells // len(every))
    last = int(at[-1]) + 1 if len(at) else 0
    for lo in range(0, last, width):
        s, e = np.searchsorted(at, [lo, lo + width])
        m = np.zeros((len(every), min(width, last - lo)), dtype=np.float32)
        m[who[s:e], at[s:e] - lo] = 1.0
        total += np.rint(m[:len(left)] @ m[len(left):].T).astype(np.int64)
    return total


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, first, t1, t2) of every document row with an id.

    ``component_id`` is the smallest id reachable by links of Jaccard >= 0.85; ``kept`` holds for that one document of
    each component.  ``first`` holds for the one text that stands for the component; t1, t2 are the text's key.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sk = materialise(sketch(docs))
    cls = classes(sk)
    reps = cls.select("rep", "n", "regs")
    keys = materialise(band_keys(reps).join(
        band_keys(reps).groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "key", "left_semi"))
    sets = _sets(docs, cls.join(keys.select("rep").distinct(), "rep", "left_semi").select("rep", "of"))
    leaders = keys.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", "key")).alias("lead"))
    star = (keys.join(leaders, "key").where("rep <> lead")
            .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct())
    links = materialise(_verified(materialise(_plausible(star, reps)), sets))
    comp = materialise(components(links))
    root = lambda k: k.join(comp.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "key", "rep", F.coalesce("root", "rep").alias("root"))
    # the one pair of a bucket of two was proposed already
    larger = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 2").select("key")
    rows = materialise(root(keys.join(larger, "key", "left_semi")))
    some = materialise(_in_cells(rows, reps, ["n", "regs"], "key long, rep long", _possible).distinct())
    second = None
    if not some.isEmpty():
        full = sets.withColumnRenamed("doc", "rep").join(reps.select("rep", "n"), "rep")
        more = _in_cells(rows.join(some, ["key", "rep"], "left_semi"), full, ["n", "elems"], "a long, b long", _joining)
        # these links are between roots: only the components that they join are contracted again
        second = materialise(components(more)).withColumnsRenamed({"node": "node2", "root": "root2"})
    named = cls.join(comp, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", "of", F.coalesce("root", "rep").alias("root"))
    if second is not None:
        named = named.join(second, F.col("root") == F.col("node2"), "left").select(
            "f1", "f2", "of", F.coalesce("root2", "root").alias("root"))
    least = F.struct(F.col("of.doc_id").alias("doc_id"), "f1", "f2")
    low = named.groupBy("root").agg(F.min(least).alias("low"))
    named = materialise(named.join(low, "root").select(
        "f1", "f2", F.col("low.doc_id").alias("component_id"), (F.col("low") == least).alias("first")))
    linked = F.col("n") > 0
    out = sk.join(named, ["f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("first")).otherwise(F.lit(True)).alias("first"), "t1", "t2")
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id")).select(
        "doc_id", "n_shingles", "component_id", "kept", "first", "t1", "t2")


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one text per component, with all their columns.

    Rows without an id stay.  Of rows that repeat an id and its text, one stays.
    """
    kept = materialise(near_duplicates(documents, id_col, text_col).where("kept and first")
                       .groupBy("doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("c")))
    row = F.col("_row")
    k1, k2 = text_key(F.coalesce(row[text_col], F.lit("")))
    rows = as_row(documents).withColumns({"_key": row[id_col].cast("long"), "_k1": k1, "_k2": k2})
    same = lambda k: (F.col("_key") == k["doc_id"]) & (F.col("_k1") == k["t1"]) & (F.col("_k2") == k["t2"])
    once, many = kept.where("c = 1"), kept.where("c > 1")
    out = rows.join(once, same(once), "left_semi").unionByName(rows.where(F.col("_key").isNull()))
    if not many.isEmpty():
        twice = rows.join(many, same(many), "left_semi")
        out = out.unionByName(twice.groupBy("_key", "_k1", "_k2").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
                              .select(*out.columns))
    return from_row(out, documents.columns)
