"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots (thousands, never
changed).  Bytes and rows are summed per slot; a small map assigns each slot to
a shard.  The map is a versioned table of ``n_slots`` rows: rebalancing and
growing edit the assignment of a few slots and store the next version, so only
the records of the edited slots move.

The only data on the driver are the ``n_slots`` sums, a fixed bound.

Defined results: a null text counts no bytes (only the fixed cost per row); an
empty table gives an empty result and a map of empty slots; null and repeated
ids are records like any other (equal ids share a slot); columns that the
caller's table has besides id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SLOTS = 4096
ROW_COST = 8

SlotRow = tuple[int, int, int]  # slot, rows, bytes


def with_slots(records: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               n_slots: int = N_SLOTS) -> DataFrame:
    """(id, size, text_crc32, v_slot) of every record; the text is read once and not moved."""
    text = F.col(text_col)
    return records.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_COST)).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_slots)).cast("int").alias("v_slot"))


def slot_sums(slotted: DataFrame, n_slots: int = N_SLOTS) -> list[SlotRow]:
    """Rows and bytes per slot, including empty slots; at most ``n_slots`` rows reach the driver."""
    got = {r["v_slot"]: (r["n"], r["b"]) for r in slotted.groupBy("v_slot").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).collect()}
    return [(s, *got.get(s, (0, 0))) for s in range(n_slots)]


def build_map(sums: Sequence[SlotRow], n_shards: int) -> dict[int, int]:
    """First version: slots by falling bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(n_shards)]
    out: dict[int, int] = {}
    for slot, _, size in sorted(sums, key=lambda x: (-x[2], x[0])):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def edit_map(old: dict[int, int], sums: Sequence[SlotRow], n_shards: int,
             tolerance: float = 0.01) -> dict[int, int]:
    """Next version for ``n_shards`` shards and the present sums.

    Slots stay where they are except those that must move: all slots of a
    shard that no longer exists, and the largest fitting slots of shards above
    the mean, which go to the lightest shard until every shard is within
    ``tolerance`` of the mean or no single move helps.
    """
    size = {s: b for s, _, b in sums}
    new = dict(old)
    load = [0] * n_shards
    homeless = []
    for slot, shard in old.items():
        if shard < n_shards:
            load[shard] += size.get(slot, 0)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-size.get(s, 0), s)):
        to = min(range(n_shards), key=lambda s: (load[s], s))
        new[slot] = to
        load[to] += size.get(slot, 0)
    mean = sum(load) / max(n_shards, 1)
    held: dict[int, list[int]] = {}
    for slot, shard in new.items():
        held.setdefault(shard, []).append(slot)
    while True:
        high = max(range(n_shards), key=lambda s: (load[s], -s))
        low = min(range(n_shards), key=lambda s: (load[s], s))
        if load[high] <= mean * (1 + tolerance) and load[low] >= mean * (1 - tolerance):
            return new
        room = (load[high] - load[low]) // 2
        fits = [s for s in held.get(high, []) if 0 < size.get(s, 0) <= room]
        if not fits:
            return new
        slot = max(fits, key=lambda s: (size[s], -s))
        held[high].remove(slot)
        held.setdefault(low, []).append(slot)
        new[slot] = low
        load[high] -= size[slot]
        load[low] += size[slot]


def map_table(spark: SparkSession, slot_map: dict[int, int], sums: Sequence[SlotRow], version: int) -> DataFrame:
    """(version, v_slot, shard, slot_rows, slot_bytes, base): ``base`` is the first
    row number of the slot inside its shard."""
    base: dict[int, int] = {}
    rows = []
    for slot, n, b in sorted(sums):
        shard = slot_map[slot]
        rows.append((version, slot, shard, n, b, base.get(shard, 0)))
        base[shard] = base.get(shard, 0) + n
    return spark.createDataFrame(
        rows, "version int, v_slot int, shard int, slot_rows long, slot_bytes long, base long")


def save_map(table: DataFrame, path: str) -> None:
    """Store one version; earlier versions stay beside it."""
    version = table.select("version").first()["version"]
    table.coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/v={version}")


def load_map(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    rows = spark.read.parquet(f"{path.rstrip('/')}/v={version}").select("v_slot", "shard").collect()
    return {r["v_slot"]: r["shard"] for r in rows}


def rebalanced(spark: SparkSession, path: str, sums: Sequence[SlotRow], n_shards: int, tolerance: float = 0.0) -> DataFrame:
    """The table of the version in use: the next one of the map stored under ``path``.

    Without a stored version the first one is built and stored.  The last stored version is then read, edited for the present
    sums and stored as the next one, and that one is read again.
    """
    last = last_version(spark, path)
    if last == 0:
        last = 1
        save_map(map_table(spark, build_map(sums, n_shards), sums, last), path)
    edited = edit_map(load_map(spark, path, last), sums, n_shards, tolerance)
    save_map(map_table(spark, edited, sums, last + 1), path)
    return map_table(spark, load_map(spark, path, last + 1), sums, last + 1)


def last_version(spark: SparkSession, path: str) -> int:
    """The highest stored version under ``path``, 0 if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return max([0, *(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())])


def assign(slotted: DataFrame, table: DataFrame) -> DataFrame:
    """Shard and gapless row number (``slot``, from 0 in its shard) of every record.

    Rows are numbered inside their virtual slot and shifted by the slot's base,
    so no task sorts a whole shard.  The map has ``n_slots`` rows: broadcast.
    """
    order = Window.partitionBy("v_slot").orderBy("doc_id", "text_crc32", "size")
    return (slotted.withColumn("in_slot", F.row_number().over(order).cast("long") - 1)
            .join(F.broadcast(table.select("v_slot", "shard", "base", "version")), "v_slot")
            .withColumn("slot", F.col("base") + F.col("in_slot")).drop("base", "in_slot"))
