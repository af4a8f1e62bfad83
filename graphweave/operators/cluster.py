"""Density clustering of embeddings (leaf clusters, min size 2, min samples 1).

With one sample per core distance the mutual-reachability distance is the
plain distance, so the cluster tree is single linkage, and with leaf
selection and a minimum size of two every cluster grows from one reciprocal
nearest-neighbour pair:

1. nearest neighbour ``nn(p)`` and distance ``d(p)`` of every point;
2. the *tree* of ``p``: follow ``p -> nn(p) -> ...`` to its reciprocal pair
   (pointer jumping, a logarithmic number of join rounds);
3. ``m(s)``: the smallest distance from a point of tree ``s`` to a point of
   another tree;
4. ``p`` belongs to the cluster of its tree when ``d(p) < m(s)``, else it is
   noise (-1); with a single tree overall everything is noise.

Cluster ids are the smallest member id.  Distances are rounded to 9 digits
and ties go to the smaller id.  Nearest-neighbour search is an exact blocked
all-pairs scan: distinct vectors are hashed into blocks of bounded size, block
pairs are formed by a cogroup, and each pair of blocks is scored by matrix
products, whose few cells near a row's least are scored again in full precision,
without materializing point pairs.  Other clustering parameters are not
offered.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Distinct vectors of a block, and the cells of one product inside a task.
BLOCK_SIZE = 32_768
CELLS = (256, 1024)


def _classes(points: DataFrame) -> DataFrame:
    """(c, vec, lo, lo2): the distinct vectors with their two smallest labels (``lo2 = lo`` where there is one)."""
    ends = points.groupBy("vec").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    second = (points.join(ends.where("hi > lo"), "vec").where("id > lo")
              .groupBy("vec").agg(F.min("id").alias("lo2")))
    return (ends.join(second, "vec", "left")
            .select(F.monotonically_increasing_id().alias("c"), "vec", "lo", F.coalesce("lo2", "lo").alias("lo2")))


def _near_cells(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray, many: np.ndarray) -> Iterator[tuple]:
    """(rows of ``a``, rows of ``b``) that hold every least distance of a row of ``a`` to the rows of ``b`` outside
    ``lo:hi``, with all ties; where ``many``, the cells at distance 0.

    Squared distances come from products in single precision and are taken with their error bound, so the true least
    cells are always among those given; the caller scores these alone.
    """
    mid = b.mean(axis=0)
    a, b = a - mid, b - mid
    scale = max(np.abs(a).max(), np.abs(b).max()) or 1.0
    a, b = a / scale, b / scale
    na, nb = (a * a).sum(1), (b * b).sum(1)
    one = lambda x: np.ones((len(x), 1))
    left = np.hstack([-2 * a, na[:, None], one(a)]).astype(np.float32)
    right = np.ascontiguousarray(np.hstack([b, one(b), nb[:, None]]).astype(np.float32).T)
    # most that a distance can be; error of a product; what rounding to 9 digits can join
    most = np.sqrt(na) + np.sqrt(nb.max())
    err = (a.shape[1] + 8) * float(np.finfo(np.float32).eps) * most ** 2
    tie = 1e-9 / scale
    room = 2 * err + 2 * most * tie + tie * tie + 1e-30
    best = np.where(many, 0.0, np.inf)
    height, width = CELLS
    for at in range(0, len(a), height):
        rows = slice(at, at + height)
        top, kept = best[rows], []
        for col in range(0, len(b), width):
            g = left[rows] @ right[:, col:col + width]
            x, y = np.clip(lo[rows] - col, 0, width), np.clip(hi[rows] - col, 0, width)
            for r in np.flatnonzero(x < y).tolist():
                g[r, x[r]:y[r]] = np.inf
            least = g.min(axis=1)
            sel = np.flatnonzero((least <= top + room[rows]) & np.isfinite(least))
            np.minimum(top, np.where(many[rows], top, least), out=top)
            if len(sel):
                r, c = np.nonzero(g[sel] <= (top + room[rows])[sel, None])
                kept.append((sel[r], c + col, g[sel[r], c]))
        if kept:
            r, c, v = (np.concatenate(k) for k in zip(*kept, strict=True))
            ok = np.isfinite(v) & (v <= (top + room[rows])[r])
            yield r[ok] + at, c[ok]


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """(c, nn_id, dist): nearest label other than its own of every vector of ``left`` among ``right``; of a vector with
    several labels the two nearest labels at all."""
    out = [pd.DataFrame({"c": np.empty(0, np.int64), "nn_id": np.empty(0, np.int64), "dist": np.empty(0)})]
    if not len(left) or not len(right):
        return out[0]
    a, b = _stack(left["vec"]), _stack(right["vec"])
    fine = np.isfinite(a).all(axis=1)
    left, a = left[fine], a[fine]
    # vectors of one label first, in the order of their labels: a row's own label is one range of them
    single = (right["lo"] == right["lo2"]).to_numpy()
    order = np.lexsort((right["lo"].to_numpy(), ~single))
    order = order[np.isfinite(b).all(axis=1)[order]]
    b, b1, b2 = b[order], right["lo"].to_numpy()[order], right["lo2"].to_numpy()[order]
    if not len(a) or not len(b):
        return out[0]
    own = b1[:int(single[order].sum())]
    c, a1 = left["c"].to_numpy(), left["lo"].to_numpy()
    many = (left["lo"] != left["lo2"]).to_numpy()
    lo, hi = (np.where(many, 0, np.searchsorted(own, a1, side)) for side in ("left", "right"))
    step = max(1, (1 << 21) // a.shape[1])
    for r, k in _near_cells(a, b, lo, hi, many):
        dist = np.concatenate([np.round(np.sqrt(((a[r[i:i + step]] - b[k[i:i + step]]) ** 2).sum(-1)), 9)
                               for i in range(0, len(r), step)] or [np.empty(0)])
        r, label, dist = np.concatenate([r, r]), np.concatenate([b1[k], b2[k]]), np.concatenate([dist, dist])
        for rank in (0, 1):
            ok = (many[r] | (label != a1[r])) & np.isfinite(dist)
            r, label, dist = r[ok], label[ok], dist[ok]
            at = np.lexsort((label, dist, r))
            first = at[np.flatnonzero(np.diff(r[at], prepend=-1))]
            out.append(pd.DataFrame({"c": c[r[first]], "nn_id": label[first], "dist": dist[first]}))
            # the second label of the rows with several
            taken = np.zeros(len(a), dtype=np.int64)
            taken[r[first]] = label[first]
            ok = many[r] & (label != taken[r])
            r, label, dist = r[ok], label[ok], dist[ok]
            if not len(r):
                break
    return pd.concat(out)


def _nearest(points: DataFrame) -> DataFrame:
    """(id, nn_id, dist): per label ``id`` the nearest vector of another label, from (id, vec); ties to the smaller label.

    Copies of a vector are compared once, under their two smallest labels: whatever the row's own label, the nearest
    other one of the copies is one of these.  Null and non-finite vectors take no part.
    """
    points = points.where("id is not null and vec is not null")
    classes = stored(_classes(points))
    n, cores = classes.count(), points.sparkSession.sparkContext.defaultParallelism
    # few large blocks, as each vector goes to every one; no fewer pairs of blocks than keep the cores busy
    nb = max(1, -(-n // BLOCK_SIZE), min(math.ceil(math.sqrt(6 * cores)), -(-n // 256)))
    mine, every = F.pmod(F.xxhash64("c"), F.lit(nb)), F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))
    left = classes.withColumn("i", mine.cast("int")).withColumn("j", every).repartition(nb * nb, "i", "j")
    right = classes.withColumn("j", mine.cast("int")).withColumn("i", every).repartition(nb * nb, "i", "j")
    cand = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(
        lambda x, y: _score(x, y), "c long, nn_id long, dist double")
    owners = (classes.where("lo = lo2").select(F.col("lo").alias("id"), "c").unionByName(
        points.join(classes.where("lo < lo2").select("vec", "c"), "vec").select("id", "c").distinct()))
    return (cand.join(owners, "c").where("id <> nn_id")
            .groupBy("id").agg(F.min(F.struct("dist", "nn_id")).alias("b"))
            .select("id", F.col("b.nn_id").alias("nn_id"), F.col("b.dist").alias("dist")))


def leaf_clusters(df: DataFrame, id_col: str, vec_col: str, max_rounds: int = 64,
                  noise: str = "minus_one") -> DataFrame:
    """(id, cluster_id) with -1 for noise, or with ``noise="singleton"`` each
    noise point in its own cluster numbered after the largest label, in id
    order (ranges of ids are counted, then numbered inside, no single task)."""
    out = _leaf_clusters(df, id_col, vec_col, max_rounds)
    if noise == "minus_one":
        return out
    out = stored(out)
    top = out.agg(F.max("cluster_id")).first()[0]
    base = (top if top is not None and top >= 0 else -1) + 1
    # id ranges hold the noise points in order: a count per range, then a rank inside it
    noise_rows = out.filter(F.col("cluster_id") == -1).select(id_col)
    parts = max(1, df.sparkSession.sparkContext.defaultParallelism)
    ranged = stored(noise_rows.repartitionByRange(parts, id_col).withColumn("__r", F.spark_partition_id()))
    ahead, bases = base, []
    for r in sorted(ranged.groupBy("__r").count().collect()):  # at most ``parts`` rows
        bases.append((r["__r"], ahead))
        ahead += r["count"]
    numbered = (ranged.join(F.broadcast(df.sparkSession.createDataFrame(bases, "__r int, __b long")), "__r")
                .withColumn("cluster_id", F.col("__b") - 1 + F.row_number().over(Window.partitionBy("__r").orderBy(id_col))))
    return out.filter(F.col("cluster_id") != -1).unionByName(
        numbered.select(F.col(id_col), F.col("cluster_id").cast("long")))


def _leaf_clusters(df: DataFrame, id_col: str, vec_col: str, max_rounds: int = 64) -> DataFrame:
    pts = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    nn = stored(_nearest(pts))
    back = nn.select(F.col("id").alias("nn_id"), F.col("nn_id").alias("nn2"))
    parent = (nn.join(back, "nn_id", "left")
              .select("id", F.when((F.col("nn2") == F.col("id")) & (F.col("id") < F.col("nn_id")), F.col("id"))
                      .otherwise(F.col("nn_id")).alias("par")))
    parent = stored(parent)
    for _ in range(max_rounds):
        step = (parent.join(parent.select(F.col("id").alias("par"), F.col("par").alias("gp")), "par")
                .select("id", "par", "gp"))
        if step.filter(F.col("par") != F.col("gp")).limit(1).count() == 0:
            break
        parent = stored(step.select("id", F.col("gp").alias("par")))
    else:
        raise RuntimeError("pointer jumping did not converge")
    tree = parent.select("id", F.col("par").alias("tree"))
    out = _nearest(pts.join(tree, "id").select(F.col("tree").alias("id"), "vec"))
    m = out.select(F.col("id").alias("tree"), F.col("dist").alias("m"))
    # read twice below: the scan of all pairs runs once
    lab = stored(nn.join(tree, "id").join(m, "tree", "left")
                 .withColumn("member", F.col("m").isNotNull() & (F.col("dist") < F.col("m"))))
    cid = lab.filter("member").groupBy("tree").agg(F.min("id").alias("cluster_id"))
    return (pts.select("id").join(lab.select("id", "tree", "member"), "id", "left").join(cid, "tree", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("member"), F.col("cluster_id")).otherwise(F.lit(-1)).cast("long").alias("cluster_id")))


def cluster_summary(labels: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Distinct cluster count (noise counted as one value), noise count, max label."""
    return labels.agg(F.countDistinct(cluster_col).alias("n_distinct"),
                      F.count_if(F.col(cluster_col) == -1).alias("n_noise"),
                      F.max(cluster_col).alias("max_label"))


def members_per_cluster(labels: DataFrame, names: DataFrame, id_col: str, name_col: str,
                        cluster_col: str = "cluster_id") -> DataFrame:
    """Names per non-noise cluster, in id order."""
    return (labels.filter(F.col(cluster_col) != -1).join(names, id_col)
            .groupBy(cluster_col).agg(F.transform(F.sort_array(F.collect_list(F.struct(id_col, name_col))),
                                                  lambda x: x[name_col]).alias("members")))
