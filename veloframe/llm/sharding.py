"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Each record hashes into one of a fixed number of virtual slots, bytes are
summed per slot, and a map says which shard holds each slot. Rebalancing edits
the map (a new version that moves few slots), never the hash, so records move
only with their slot. The map has one row per slot, whatever the data's size.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Virtual slots; thousands, so that a shard's share can be set finely.
SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` is the slot's shard."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]


def initial_map(n_shards: int, n_slots: int = SLOTS) -> SlotMap:
    return SlotMap(0, n_shards, tuple(s % n_shards for s in range(n_slots)))


def rebalance(old: SlotMap, slot_bytes: dict[int, int], n_shards: int | None = None,
              slack: float = 0.03) -> SlotMap:
    """The next version of the map, with near-equal bytes per shard.

    Each shard keeps its largest slots up to its even share less ``slack``;
    the others go, largest first, to the shard with the fewest bytes. Empty
    slots stay. With a larger ``n_shards`` the new shards start empty.
    """
    n = n_shards or old.n_shards
    keep_to = sum(slot_bytes.values()) / n * (1 - slack)
    shard_of, load, loose = list(old.shard_of), [0] * n, []
    for slot in sorted(slot_bytes, key=lambda s: (-slot_bytes[s], s)):
        size, shard = slot_bytes[slot], shard_of[slot]
        if size and (shard >= n or load[shard] + size > keep_to):
            loose.append(slot)
        elif shard < n:
            load[shard] += size
    heap = [(x, s) for s, x in enumerate(load)]
    heapq.heapify(heap)
    for slot in loose:
        x, s = heapq.heappop(heap)
        shard_of[slot] = s
        heapq.heappush(heap, (x + slot_bytes[slot], s))
    return SlotMap(old.version + 1, n, tuple(s if s < n else i % n for i, s in enumerate(shard_of)))


def save_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Store one version below ``path``; an existing version is never overwritten."""
    rows = [(slot, shard, slot_map.n_shards) for slot, shard in enumerate(slot_map.shard_of)]
    (spark.createDataFrame(rows, "virtual_slot int, shard int, n_shards int").coalesce(1)
     .write.mode("errorifexists").parquet(f"{path}/version={slot_map.version}"))


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(virtual_slot, shard, n_shards, map_version) of one stored version."""
    return (spark.read.parquet(f"{path}/version={version}")
            .withColumn("map_version", F.lit(version)))


def with_virtual_slot(df: DataFrame, key: str, other: str, n_slots: int = SLOTS) -> DataFrame:
    """Adds ``virtual_slot``, a hash of ``key``; where that is null, of ``other``."""
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key))).otherwise(F.xxhash64(F.col(other)))
    return df.withColumn("virtual_slot", F.pmod(hashed, F.lit(n_slots)).cast("int"))


def slot_bytes(slotted: DataFrame, size: str) -> dict[int, int]:
    """Bytes per virtual slot; at most one row per slot comes to the driver."""
    return {r[0]: int(r[1]) for r in slotted.groupBy("virtual_slot").agg(F.sum(size)).collect()}


def place(slotted: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``shard``, ``map_version`` and ``slot``, the record's place in its shard from 0.

    Places run by virtual slot, then ``order``: a shard's rows are never
    gathered, only those of one virtual slot are sorted together. Records
    equal in ``order`` take any order among them.
    """
    mapped = F.broadcast(slot_map.select("virtual_slot", "shard", "map_version"))
    starts = (slotted.groupBy("virtual_slot").agg(F.count("*").alias("__n"))
              .join(mapped, "virtual_slot")
              .withColumn("__start", F.coalesce(F.sum("__n").over(
                  Window.partitionBy("shard").orderBy("virtual_slot")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("__n"))
    within = Window.partitionBy("virtual_slot").orderBy(*order)
    return (slotted.withColumn("__place", F.row_number().over(within) - 1)
            .join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", (F.col("__place") + F.col("__start")).cast("long"))
            .drop("__place", "__start"))
