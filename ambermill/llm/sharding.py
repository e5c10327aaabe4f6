"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ambermill.session import checkpoint_root

SLOTS = 16_384


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds each slot. Maps are never changed; an edit makes the next version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    @classmethod
    def balanced(cls, slot_bytes: Mapping[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
        """First map: slots by falling bytes, each to the shard with the least so far (ties: fewer slots, lower number)."""
        heap = [(0, 0, s) for s in range(shards)]
        out = [0] * slots
        for slot in sorted(range(slots), key=lambda k: (-slot_bytes.get(k, 0), k)):
            load, n, s = heapq.heappop(heap)
            out[slot] = s
            heapq.heappush(heap, (load + slot_bytes.get(slot, 0), n + 1, s))
        return cls(1, shards, tuple(out))

    def loads(self, slot_bytes: Mapping[int, int]) -> list[int]:
        out = [0] * self.shards
        for slot, s in enumerate(self.shard_of):
            out[s] += slot_bytes.get(slot, 0)
        return out

    def grown(self, slot_bytes: Mapping[int, int]) -> SlotMap:
        """One more shard. It takes slots from the fullest shards until it has its share; no other slot moves."""
        out, new = list(self.shard_of), self.shards
        loads = [*self.loads(slot_bytes), 0]
        goal = sum(loads) / (self.shards + 1)
        own: dict[int, list[int]] = {}
        for slot, s in enumerate(out):
            own.setdefault(s, []).append(slot)
        for slots in own.values():
            slots.sort(key=lambda k: (-slot_bytes.get(k, 0), k))
        heap = [(-loads[s], s) for s in range(self.shards)]
        heapq.heapify(heap)
        while heap and loads[new] < goal:
            _, s = heapq.heappop(heap)
            fitting = next((k for k in own.get(s, []) if slot_bytes.get(k, 0) and loads[new] + slot_bytes[k] <= goal * 1.01), None)
            if fitting is None:
                continue
            own[s].remove(fitting)
            out[fitting] = new
            loads[s] -= slot_bytes[fitting]
            loads[new] += slot_bytes[fitting]
            heapq.heappush(heap, (-loads[s], s))
        return SlotMap(self.version + 1, self.shards + 1, tuple(out))

    def rebalanced(self, slot_bytes: Mapping[int, int], tolerance: float = 0.01) -> SlotMap:
        """Move slots from the fullest to the emptiest shard while that narrows the gap beyond the tolerance."""
        out, loads = list(self.shard_of), self.loads(slot_bytes)
        own: dict[int, set[int]] = {}
        for slot, s in enumerate(out):
            own.setdefault(s, set()).add(slot)
        mean = sum(loads) / self.shards
        while True:
            hi, lo = max(range(self.shards), key=loads.__getitem__), min(range(self.shards), key=loads.__getitem__)
            gap = loads[hi] - loads[lo]
            if gap <= tolerance * mean:
                break
            movable = [k for k in own.get(hi, ()) if 0 < slot_bytes.get(k, 0) < gap]
            if not movable:
                break
            k = min(movable, key=lambda k: (abs(gap / 2 - slot_bytes[k]), k))
            own[hi].remove(k)
            own.setdefault(lo, set()).add(k)
            out[k] = lo
            loads[hi] -= slot_bytes[k]
            loads[lo] += slot_bytes[k]
        return SlotMap(self.version + 1, self.shards, tuple(out))

    def save(self, spark: SparkSession, root: str) -> str:
        """Write <root>/version=<n>; an existing version is not replaced."""
        path = f"{root.rstrip('/')}/version={self.version}"
        rows = [(k, s) for k, s in enumerate(self.shard_of)]
        spark.createDataFrame(rows, "vslot int, shard int").coalesce(1).write.mode("error").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, root: str, version: int) -> SlotMap:
        rows = sorted(spark.read.parquet(f"{root.rstrip('/')}/version={version}").collect())
        return cls(version, 1 + max(r.shard for r in rows), tuple(r.shard for r in rows))


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def sized(docs: DataFrame, text: str, doc_id: str, slots: int) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 16), text_crc32 and virtual slot. NULL texts have no bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        virtual_slot(F.struct(F.col(doc_id), F.crc32(F.encode(body, "UTF-8"))), slots).alias("vslot"),
    )


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """{slot: (bytes, rows)}: as many entries as there are slots, whatever the table's size."""
    got = rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    return {r["vslot"]: (r["b"], r["n"]) for r in got}


def shard_documents(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS, map_root: str | None = None) -> DataFrame:
    """Deal all documents into shards of nearly equal bytes.

    Returns doc_id, size, text_crc32, vslot (the virtual slot), shard and slot: the row's place in its shard, gapless from 0. A row's virtual slot
    comes from a hash of doc_id and text, so a doc_id that many rows repeat is spread; slots are dealt to shards
    by their bytes, and the map is stored as version 1 under map_root (by default in the session's shared folder). Places are counted inside
    virtual slots, which are small, and moved by the number of rows in the shard's slots before; no shard meets in one task. Rows
    that are equal in all may swap places. NULL texts count 16 bytes, NULL ids are a value, an empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = sized(docs, text, doc_id, slots)
    totals = slot_totals(rows)
    first = SlotMap.balanced({k: b for k, (b, _) in totals.items()}, shards, slots)
    first.save(spark, map_root or f"{checkpoint_root(spark).rstrip('/')}/ambermill/slotmaps/{uuid.uuid4().hex}")
    before, table = [0] * shards, []
    for k, s in enumerate(first.shard_of):
        if k in totals:
            table.append((k, s, before[s]))
            before[s] += totals[k][1]
    placed = spark.createDataFrame(table, "vslot int, shard int, before long").hint("broadcast" if len(table) <= 1 << 16 else "shuffle_hash")
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")))
    return numbered.join(placed, "vslot").select("doc_id", "size", "text_crc32", "vslot", "shard", (F.col("before") + F.col("_n") - 1).alias("slot"))

