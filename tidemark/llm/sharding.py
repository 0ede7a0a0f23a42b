"""Shards over fixed virtual slots.

A record's id is hashed into one of a fixed number of virtual slots, bytes are summed per slot, and a versioned
map says which shard each slot is in. Version 1 deals the slots out evenly; rebalancing edits it: slots move from
the fullest shards to the emptiest until sizes are near equal, and all other slots stay. Adding records or
rebalancing never rehashes a record. The map has as many entries as slots, whatever the number of records, so it
is planned on the driver from one aggregate of that size.

The law is that of bytes: it says nothing of where equal texts go, which have an equal size and CRC and may be in
different shards.

Defined results: a record with a null id is hashed by its text, so that many of them are spread; rows that repeat an id
share its slot; a null text has size 1 and the CRC of the empty string; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, texts

N_SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """shard_of[slot] for every virtual slot; moved: the slots that differ from the version before."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]
    moved: tuple[int, ...] = field(default=())

    @staticmethod
    def even(n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
        return SlotMap(1, n_shards, tuple(slot % n_shards for slot in range(n_slots)))

    def rebalanced(self, slot_bytes: dict[int, int], tolerance: float = 0.001) -> SlotMap:
        """The next version: slots moved or swapped from the fullest to the emptiest shard while that helps.

        Ends when all shards are within `tolerance` of the mean or no move or swap of two slots brings the
        fullest and the emptiest shard closer.
        """
        shard_of, load = list(self.shard_of), [0] * self.n_shards
        own: list[set[int]] = [set() for _ in load]
        for slot, shard in enumerate(shard_of):
            load[shard] += slot_bytes.get(slot, 0)
            own[shard].add(slot)
        mean = sum(load) / self.n_shards
        for _ in range(8 * len(shard_of)):
            full, empty = max(range(self.n_shards), key=lambda s: (load[s], -s)), min(range(self.n_shards), key=lambda s: (load[s], s))
            gap = load[full] - load[empty]
            if gap <= max(1.0, tolerance * mean):
                break
            sizes = sorted((slot_bytes.get(s, 0), s) for s in own[empty])
            best = None
            for slot in own[full]:
                n = slot_bytes.get(slot, 0)
                for other, m in ((None, 0), _nearest(sizes, n - gap / 2)):
                    if 0 < n - m < gap and (best is None or (abs(gap - 2 * (n - m)), slot) < best[:2]):
                        best = (abs(gap - 2 * (n - m)), slot, other, n - m)
            if best is None:
                break
            _, slot, other, delta = best
            own[full].discard(slot), own[empty].add(slot)
            shard_of[slot] = empty
            if other is not None:
                own[empty].discard(other), own[full].add(other)
                shard_of[other] = full
            load[full] -= delta
            load[empty] += delta
        return SlotMap(self.version + 1, self.n_shards, tuple(shard_of), tuple(s for s, x in enumerate(shard_of) if x != self.shard_of[s]))

    def grown(self, slot_bytes: dict[int, int]) -> SlotMap:
        """The next version with one more shard, which takes slots from the fullest shards and gives none."""
        shard_of, load = list(self.shard_of), [0] * self.n_shards
        own: list[list[int]] = [[] for _ in load]
        for slot in sorted(range(len(shard_of)), key=lambda s: (slot_bytes.get(s, 0), s)):
            load[shard_of[slot]] += slot_bytes.get(slot, 0)
            own[shard_of[slot]].append(slot)
        heap, target, taken = [(-n, s) for s, n in enumerate(load)], sum(load) / (self.n_shards + 1), 0
        heapq.heapify(heap)
        while heap and taken < target:
            n, shard = heapq.heappop(heap)
            if not own[shard]:
                continue
            slot = own[shard].pop()
            size = slot_bytes.get(slot, 0)
            if size and taken + size <= target * 1.0001 + 1:
                shard_of[slot], taken = self.n_shards, taken + size
                n += size
            heapq.heappush(heap, (n, shard))
        return SlotMap(self.version + 1, self.n_shards + 1, tuple(shard_of), tuple(s for s, x in enumerate(shard_of) if x != self.shard_of[s]))

    def column(self, slot: Column) -> Column:
        """The shard of a slot, as a lookup in an array literal of one entry per slot."""
        return F.get(F.lit(list(self.shard_of)), slot.cast("int"))

    def table(self, spark) -> DataFrame:
        """(version, slot, shard): what is stored; a version is appended, never changed."""
        return spark.range(0, len(self.shard_of), 1, 1).select(F.lit(self.version).alias("version"), F.col("id").cast("int").alias("slot"), self.column(F.col("id")).alias("shard"))

    def save(self, spark, path: str) -> None:
        """Adds this version to the maps at a path, in a folder of its own; one that is there is an error."""
        self.table(spark).drop("version").write.mode("errorifexists").parquet(f"{path}/version={self.version}")

    @staticmethod
    def load(spark, path: str, version: int | None = None) -> SlotMap:
        """A version at a path, or the latest."""
        maps = spark.read.parquet(path)
        version = maps.agg(F.max("version")).first()[0] if version is None else version
        rows = maps.where(F.col("version") == version).orderBy("slot").collect()  # one row for each slot
        return SlotMap(version, max(r["shard"] for r in rows) + 1, tuple(r["shard"] for r in rows))


def _nearest(sizes: list[tuple[int, int]], wanted: float) -> tuple[int | None, int]:
    import bisect

    if not sizes or wanted < 0:
        return None, 0
    at = bisect.bisect(sizes, (wanted, -1))
    n, slot = min((sizes[i] for i in (at - 1, at) if 0 <= i < len(sizes)), key=lambda x: (abs(x[0] - wanted), x[1]))
    return slot, n


def virtual_slot(key: Column, n_slots: int = N_SLOTS) -> Column:
    """The fixed slot of a key: the first 32 bits of its MD5, modulo the number of slots."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % n_slots).cast("int")


def sized(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of each record, without the text."""
    own = texts(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    return own.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), virtual_slot(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(text.cast("binary")))), n_slots).alias("vslot"))


def slot_bytes(records: DataFrame) -> DataFrame:
    """(vslot, bytes, rows): at most one row for each slot."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def assign(docs: DataFrame, n_shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS, current: SlotMap | None = None, store: str | None = None) -> tuple[DataFrame, SlotMap]:
    """(doc_id, size, text_crc32, vslot, shard, slot) of each record, and the map in force.

    slot: the record's place in its shard, from 0 without gaps: places are counted inside virtual slots, each of
    which starts where the one before it in the shard ends. current: the map to edit, else version 1. store: a path
    to which the versions made here are added.
    """
    records = cut(sized(docs, id_col=id_col, text_col=text_col, n_slots=n_slots))
    per_slot = slot_bytes(records).collect()  # one row for each virtual slot at most
    first = current or SlotMap.even(n_shards, n_slots)
    plan = first.rebalanced({r["vslot"]: r["bytes"] for r in per_slot})
    if store:
        for made in (plan,) if current else (first, plan):
            made.save(docs.sparkSession, store)
    start, filled = [0] * n_slots, [0] * plan.n_shards
    for r in sorted(per_slot, key=lambda r: r["vslot"]):
        start[r["vslot"]] = filled[plan.shard_of[r["vslot"]]]
        filled[plan.shard_of[r["vslot"]]] += r["rows"]
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")) - 1
    slot = F.get(F.lit(start), F.col("vslot")) + place
    return records.select("doc_id", "size", "text_crc32", "vslot", plan.column(F.col("vslot")).alias("shard"), slot.cast("long").alias("slot")), plan
