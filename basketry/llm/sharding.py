"""Sharding by fixed virtual slots: rows hash into slots, and a stored, versioned map gives slots to shards."""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import texts
from basketry.scratch import Scratch

SLOTS = 4096
# A slot that outweighs a shard is dealt out in so many parts; rows also get their places by parts.
PARTS = 16
WHOLE = -1

MAP_SCHEMA = "version int, slot int, part int, bytes long, shard int"


@dataclass(frozen=True)
class Unit:
    """What moves as one: a slot, or a part of a slot that is heavier than a shard."""

    slot: int
    part: int
    bytes: int


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size (bytes of the text and 1 for its end), text_crc32, virtual_slot and part of every row.

    The slot comes from the text alone, so equal texts share one. A null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    return texts(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int").alias("part"),
    )


def units(loads: DataFrame, shards: int) -> list[Unit]:
    """Slots with their bytes; those above a shard's fair share in parts. At most (SLOTS + shards * PARTS) entries."""
    slots = {r.virtual_slot: r.bytes for r in loads.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes")).collect()}
    fair = sum(slots.values()) / shards
    heavy = [s for s, b in slots.items() if b > fair]
    parts = loads.where(F.col("virtual_slot").isin(heavy)).collect() if heavy else []
    light = [Unit(s, WHOLE, b) for s, b in slots.items() if b <= fair]
    return light + [Unit(r.virtual_slot, r.part, r.bytes) for r in parts]


def assign(loads: Iterable[Unit], shards: int) -> list[tuple[Unit, int]]:
    """A first map: the heaviest unit first, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for unit in sorted(loads, key=lambda u: (-u.bytes, u.slot, u.part)):
        filled, shard = heapq.heappop(heap)
        placed.append((unit, shard))
        heapq.heappush(heap, (filled + unit.bytes, shard))
    return placed


def grow(placed: list[tuple[Unit, int]], shards: int) -> list[tuple[Unit, int]]:
    """Edit the map for one more shard: units move into the new shard only, until it holds its fair share."""
    filled = [0] * (shards + 1)
    for unit, shard in placed:
        filled[shard] += unit.bytes
    fair = sum(filled) / (shards + 1)
    moved: dict[Unit, int] = {}
    for unit, shard in sorted(placed, key=lambda p: (-p[0].bytes, p[0].slot, p[0].part)):
        if filled[shard] - unit.bytes >= fair * 0.98 and filled[shards] + unit.bytes <= fair * 1.02:
            filled[shard] -= unit.bytes
            filled[shards] += unit.bytes
            moved[unit] = shards
    return [(unit, moved.get(unit, shard)) for unit, shard in placed]


def map_frame(spark: SparkSession, placed: Iterable[tuple[Unit, int]], version: int) -> DataFrame:
    return spark.createDataFrame([(version, u.slot, u.part, u.bytes, shard) for u, shard in placed], MAP_SCHEMA)


def save_map(spark: SparkSession, path: str, placed: Iterable[tuple[Unit, int]], version: int) -> None:
    """Add a version to the stored map; older versions stay, so that earlier placements can be looked up."""
    map_frame(spark, placed, version).coalesce(1).drop("version").write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> list[tuple[Unit, int]]:
    """A version of the stored map: bounded like ``units``."""
    rows = spark.read.schema(MAP_SCHEMA.replace("version int, ", "")).parquet(f"{path}/version={version}").collect()
    return [(Unit(r.slot, r.part, r.bytes), r.shard) for r in rows]


def shard(docs: DataFrame, work: Scratch, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into a shard: doc_id, size, text_crc32, virtual_slot, shard, slot (its place there, from 0).

    Bytes of the shards are near equal. Equal texts share a shard, unless their slot outweighs a
    shard: then it is dealt out in parts. Rows with null or repeated ids and repeated rows are placed
    like any others, very long texts by their size alone; an empty table gives an empty result.

    The digest of the rows is written once, since the part of a row depends on where it is read.
    Only sums per slot and part leave the tasks: at most SLOTS * PARTS rows, the bound of what is
    broadcast; the driver sees one row per slot.
    """
    spark = docs.sparkSession
    rows = work.keep(digest(docs, id_col, text_col), "digest")
    loads = work.keep(
        rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "loads"
    )
    path = work.path("slot-map")
    save_map(spark, path, assign(units(loads, shards), shards), version=1)
    placed = map_frame(spark, load_map(spark, path, 1), 1).select(
        F.col("slot").alias("virtual_slot"), F.col("part").alias("map_part"), "shard"
    )
    order = Window.partitionBy("shard").orderBy("virtual_slot", "part")
    starts = (
        loads.join(F.broadcast(placed), "virtual_slot")
        .where((F.col("map_part") == WHOLE) | (F.col("map_part") == F.col("part")))
        .withColumn("start", F.sum("n").over(order) - F.col("n"))
        .select("virtual_slot", "part", "shard", "start")
    )
    starts = work.keep(starts, "starts")
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.join(F.broadcast(starts), ["virtual_slot", "part"])
        .withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
        .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot")
    )


def op1_sharding(docs: DataFrame, work: Scratch) -> DataFrame:
    return shard(docs, work, shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
