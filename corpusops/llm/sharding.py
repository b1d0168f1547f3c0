"""Sharding through fixed virtual slots: records hash into thousands of slots, and a small versioned table says which shard has which slot."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusops.llm.store import Workspace

VIRTUAL_SLOTS = 4096
SHARDS = 24
ROW_BYTES = 8
REPEATS = 4096


def slotted(docs: DataFrame, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot): the slot is fixed by the record, never by shards. Null text: size 8, CRC of nothing.

    Equal records are numbered and hashed with their number, so that a hot one is dealt over all slots. They are counted before the shuffle
    and made again from the count, in two steps so that no task makes more than `REPEATS` at once.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    record = ["doc_id", "size", "text_crc32"]
    rows = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    counted = rows.groupBy(*record).agg(F.count("*").alias("n"))
    runs = counted.select(*record, "n", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1) - F.pmod(F.col("n") - 1, F.lit(REPEATS)), F.lit(REPEATS).cast("long"))).alias("from"))
    each = runs.repartition(*record, "from").select(*record, F.explode(F.sequence("from", F.least(F.col("from") + REPEATS, "n") - 1)).alias("nth"))
    own = F.when(F.col("nth") == 0, F.xxhash64(*record)).otherwise(F.xxhash64(*record, "nth"))
    return each.select(*record, F.pmod(own, F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows per virtual slot; at most as many entries as there are slots, whatever the input."""
    return {r.virtual_slot: (r.bytes, r.rows) for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}


def first_map(loads: dict[int, tuple[int, int]], slots: int, shards: int) -> list[int]:
    """Shard of each slot: the heaviest slot goes to the lightest shard, again and again."""
    heap = [(0, 0, s) for s in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda v: (-loads.get(v, (0, 0))[0], v)):
        size, n, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (size + loads.get(slot, (0, 0))[0], n + 1, shard))
    return owner


def edited_map(owner: list[int], loads: dict[int, tuple[int, int]], shards: int, tolerance: float = 0.01) -> list[int]:
    """The map changed as little as is needed: slots of dropped shards move, then slots move from the heaviest to the lightest shard until both are within `tolerance` of the mean."""
    size = lambda v: loads.get(v, (0, 0))[0]
    owner, held = list(owner), [set() for _ in range(shards)]
    total = [0] * shards
    homeless = [v for v, s in enumerate(owner) if s >= shards]
    for v, s in enumerate(owner):
        if s < shards:
            held[s].add(v)
            total[s] += size(v)

    def give(v: int, s: int) -> None:
        owner[v] = s
        held[s].add(v)
        total[s] += size(v)

    for v in sorted(homeless, key=lambda v: (-size(v), v)):
        give(v, min(range(shards), key=lambda s: (total[s], s)))
    mean = sum(total) / shards
    for _ in range(len(owner)):
        high, low = max(range(shards), key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[high] - total[low]
        fits = [v for v in held[high] if 0 < size(v) < gap]
        if not fits or max(total[high] - mean, mean - total[low]) <= tolerance * mean:
            break
        v = min(fits, key=lambda v: (abs(gap / 2 - size(v)), v))
        held[high].remove(v)
        total[high] -= size(v)
        give(v, low)
    return owner


def map_table(spark: SparkSession, owner: list[int], loads: dict[int, tuple[int, int]], version: int) -> DataFrame:
    """(version, virtual_slot, shard, bytes, rows, first_row): `first_row` is the number of rows in the shard's lower slots."""
    seen: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(owner):
        size, n = loads.get(slot, (0, 0))
        rows.append((version, slot, shard, size, n, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + n
    return spark.createDataFrame(rows, "version int, virtual_slot int, shard int, bytes long, rows long, first_row long")


def assigned(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """`rows` with their shard and `slot`, their place in it, gapless from 0: by virtual slot, then doc_id, size and CRC.

    Rows are ranked inside a virtual slot only, a few thousandths of the table; the map has one row per slot and is broadcast.
    """
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    placed = rows.withColumn("place", F.row_number().over(inside) - 1)
    held = slot_map.select("virtual_slot", "shard", "first_row", F.col("version").alias("map_version"))
    return placed.join(F.broadcast(held), "virtual_slot").withColumn("slot", (F.col("first_row") + F.col("place")).cast("long")).drop("first_row", "place")


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = VIRTUAL_SLOTS, previous: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with shard and slot, map). Law: bytes; shards have near equal sizes. With a `previous` map only the slots that must move do.

    Only doc_id, size and checksum are shuffled, not texts. Rows with null doc_id are dealt by size and checksum; equal rows are dealt by
    their number; an empty table gives an empty one and a map all the same.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "shards")
    rows = work.keep(slotted(docs, slots), "rows")
    loads = slot_loads(rows)
    if previous is None:
        owner, version = first_map(loads, slots, shards), 0
    else:
        old = {r.virtual_slot: r for r in previous.collect()}
        owner, version = edited_map([old[v].shard for v in range(slots)], loads, shards), old[0].version + 1
    slot_map = work.keep(map_table(spark, owner, loads, version).coalesce(1), f"map-{version}")
    return assigned(rows, slot_map), slot_map


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
