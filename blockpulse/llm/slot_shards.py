"""Sharding by fixed virtual slots.

Every record hashes to one of a fixed number of slots, bytes are summed per slot, and a small map says
which shard each slot belongs to. Only the map is edited when shards are added or loads change, and
each edit is a new version, so records move slot by slot. All work on rows is DataFrame functions; the
map has one entry per slot, whatever the size of the data.

Rows and edge cases: a NULL text has no bytes and the checksum of an empty text; rows hash by id and
text, so rows without an id spread out by their text; a repeated row hashes by its number among its
repeats too, so repeats spread over slots, the same ones on every run; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockpulse.llm.repeats import numbered
from blockpulse.llm.scratch import Scratch

SLOTS = 16_384
#: Bytes counted for a record besides its text.
OVERHEAD = 16


KEY = ["id", "text_crc32", "size"]


def numbered_repeats(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """`rows` with `repeat`: the number of a row among those of its KEY, from 0."""
    return numbered(rows, KEY, scratch)


def records(docs: DataFrame, scratch: Scratch, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, virtual_slot) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    # Range partitioning reads its input twice: the texts are read once before.
    numbered = numbered_repeats(scratch.write(narrow, "narrow", merged=False), scratch)
    hashed = F.when(F.col("repeat") == 0, F.xxhash64(*KEY)).otherwise(F.xxhash64(*KEY, "repeat"))
    return numbered.select("id", "size", "text_crc32", F.pmod(hashed, F.lit(slots)).alias("virtual_slot"))


def slot_loads(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows), summed on the map side first: at most one row per slot and task."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def balanced_map(loads: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """Shard of each slot: largest slot first, always to the shard with the fewest bytes."""
    heap = [(0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        held, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (held + loads.get(slot, 0), shard))
    return owner


def grown_map(owner: list[int], loads: dict[int, int], shards: int) -> list[int]:
    """The map after one more shard: slots move into it only, each from the fullest shard that can spare it."""
    held, slots_of = [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        held[shard] += loads.get(slot, 0)
        slots_of[shard].append(slot)
    for own in slots_of:
        own.sort(key=lambda s: (loads.get(s, 0), -s))
    goal, moved, grown = sum(held) / (shards + 1), 0, list(owner)
    heap = [(-bytes_, shard) for shard, bytes_ in enumerate(held)]
    heapq.heapify(heap)
    while heap and moved < goal:
        full, shard = heapq.heappop(heap)
        if not slots_of[shard]:
            continue
        slot = slots_of[shard].pop()
        weight = loads.get(slot, 0)
        if moved + weight <= goal:
            grown[slot], moved, full = shards, moved + weight, full + weight
        heapq.heappush(heap, (full, shard))
    return grown


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """(virtual_slot, shard, map_version): one row per slot and version of the map."""
    out = None
    for version, owner in enumerate(versions, start=1):
        shard = F.get(F.from_json(F.lit(json.dumps(owner)), "array<int>"), F.col("id").cast("int"))
        one = spark.range(len(owner)).select(F.col("id").alias("virtual_slot"), shard.alias("shard"), F.lit(version).alias("map_version"))
        out = one if out is None else out.unionAll(one)
    return out


def shard_documents(
    docs: DataFrame, shards: int = 40, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, virtual_slot, shard, place, map_version, next_shard) for every row.

    Version 1 of the map balances bytes over `shards`; version 2 edits it for one more, `next_shard`.
    `place` counts the rows of a shard from 0: the rows of its earlier slots, then a row number inside
    the slot, so no shard is sorted as a whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "slots")
    rows = scratch.write(records(docs, scratch, slots, id_col, text_col), "records", merged=False)
    loads = scratch.write(slot_loads(rows), "loads")
    weights = {r.virtual_slot: r.bytes for r in loads.select("virtual_slot", "bytes").toLocalIterator()}
    first = balanced_map(weights, shards, slots)
    versions = scratch.write(map_table(spark, [first, grown_map(first, weights, shards)]), "map")

    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    current = versions.where("map_version = 1").join(loads, "virtual_slot", "left")
    placed = current.select("virtual_slot", "shard", "map_version", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("_before"))
    after = versions.where("map_version = 2").select("virtual_slot", F.col("shard").alias("next_shard"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("_row", F.row_number().over(in_slot))
    plan = scratch.write(placed.join(after, "virtual_slot"), "plan")
    # The plan has one row per slot: a bounded side.
    joined = numbered.join(F.broadcast(plan), "virtual_slot")
    place: Column = (F.col("_before") + F.col("_row") - 1).cast("long").alias("place")
    return joined.select("id", "size", "text_crc32", "virtual_slot", "shard", place, "map_version", "next_shard")
