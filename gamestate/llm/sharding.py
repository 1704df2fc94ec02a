"""Sharding over fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its doc_id, one of SLOTS. Bytes and rows are summed per slot, and a map from slots to
shards is kept at a path, one folder for each version. The first version deals slots out largest first to the shard that
has the fewest bytes. Every later run reads the latest version, edits it where bytes have moved or shards were added, and
writes the next one; slots move, records keep their slots, and all versions stay readable. So a repeated run may depend on
what earlier ones left at the path. A version is written apart and then renamed, which fails if another run was first; then
the newer version is read and edited. A run that ends before the rename leaves no version. Only the map's SLOTS rows are
ever on the driver, whatever the number of records.

An id that alone holds more than HOT of a shard's fair share (a bounded number of ids can) is spread: its rows are hashed
with their place in their file, so no slot, shard or task takes all of them.

Defined results: a null text has size 16 and the checksum of the empty text; a null doc_id is hashed with the text's
checksum; repeated rows share a slot unless their id is spread; an empty table gives no rows and no map; columns besides
doc_id and text are not looked at. A single row above the fair share stays whole: its shard holds it and what must be.
"""

from __future__ import annotations

import heapq
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamestate.llm.common import exists, materialize, move_new

SLOTS = 8192
OVERHEAD = 16
HOT = 1 / 8
SPREAD = 1024
#: Shards within this share of the mean are balanced enough, so no slot moves.
SLACK = 0.01
MAP = "virtual_slot int, shard int, slot_bytes long, slot_rows long, rows_before long"


def in_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, the hashed key and virtual_slot of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        crc.alias("text_crc32"),
        F.xxhash64(F.coalesce("doc_id", crc)).alias("key"),
    )
    return rows.withColumn("virtual_slot", F.pmod("key", F.lit(slots)).cast("int"))


def slot_sizes(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))


def spread_hot(records: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Records (read from files) whose hot ids are spread over SPREAD slots."""
    sizes = {r["virtual_slot"]: r["slot_bytes"] for r in slot_sizes(records).collect()}  # at most `slots` rows
    most = HOT * sum(sizes.values()) / shards
    heavy = [s for s, n in sizes.items() if n > most]
    if not heavy:
        return records
    # at most shards / HOT keys can hold that much
    by_key = records.where(F.col("virtual_slot").isin(heavy)).groupBy("key").agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
    hot = [r["key"] for r in by_key.where((F.col("n") > most) & (F.col("rows") > 1)).collect()]
    place = F.pmod(F.xxhash64("key", F.pmod(F.col("_metadata.row_index"), F.lit(SPREAD))), F.lit(slots)).cast("int")
    return records.withColumn("virtual_slot", F.when(F.col("key").isin(hot), place).otherwise(F.col("virtual_slot"))) if hot else records


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions of the map at path, with the column version; None where there is none."""
    complete = [f"{path}/version={v}" for v in _numbers(spark, path) if exists(spark, f"{path}/version={v}/_SUCCESS")]
    return spark.read.schema(f"{MAP}, version int").option("basePath", path).parquet(*complete) if complete else None


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions that have a folder, complete or not."""
    if not exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return [int(m[1]) for n in names if (m := re.fullmatch(r"version=(\d+)", n))]


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """One version of the map at path, the latest if none is named."""
    found = versions(spark, path)
    if found is None:
        return None
    version = found.agg(F.max("version")).first()[0] if version is None else version
    return found.where(F.col("version") == version)


def dealt(sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """The shard of each slot, largest slots first to the shard with the fewest bytes."""
    heap, out = [(0, s) for s in range(shards)], {}
    for slot, (n, _) in sorted(sizes.items(), key=lambda x: (-x[1][0], x[0])):
        held, shard = heapq.heappop(heap)
        heapq.heappush(heap, (held + n, shard))
        out[slot] = shard
    return out


def edited(shard_of: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """The map for changed sizes or a changed number of shards: few slots move, each from the fullest shard to the emptiest.

    Slots without a shard, as those of removed shards, go to the emptiest first. Shards within SLACK of the mean are left
    alone, so with more shards slots move to the new ones only, where the slots are small enough.
    """
    shard_of = {s: k for s, k in shard_of.items() if s in sizes and k < shards}
    held, own = [0] * shards, [[] for _ in range(shards)]
    for slot, k in shard_of.items():
        held[k] += sizes[slot][0]
        own[k].append((sizes[slot][0], slot))
    for slot, (n, _) in sorted(sizes.items(), key=lambda x: (-x[1][0], x[0])):
        if slot not in shard_of:
            k = min(range(shards), key=lambda s: (held[s], s))
            shard_of[slot] = k
            held[k] += n
            own[k].append((n, slot))
    for x in own:
        x.sort()
    slack = SLACK * sum(held) / shards
    while True:
        full, low = max(range(shards), key=lambda s: (held[s], -s)), min(range(shards), key=lambda s: (held[s], s))
        gap = held[full] - held[low]
        fits = [x for x in own[full] if 0 < x[0] < gap]
        if gap <= 2 * slack or not fits:
            return shard_of
        n, slot = next((x for x in reversed(fits) if 2 * x[0] <= gap), fits[0])
        own[full].remove((n, slot))
        own[low].append((n, slot))
        own[low].sort()
        held[full] -= n
        held[low] += n
        shard_of[slot] = low


def rebalance(spark: SparkSession, sizes: DataFrame, shards: int, path: str) -> DataFrame:
    """The map for these slot sizes: the latest version at path if nothing has changed, else a new version written there.

    If another run writes that version meanwhile, its map is what is edited next.
    """
    while (done := _rebalanced(spark, sizes, shards, path)) is None:
        pass
    return done


def _rebalanced(spark: SparkSession, sizes: DataFrame, shards: int, path: str) -> DataFrame | None:
    """None if another run has taken the version."""
    now = {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in sizes.collect()}  # one row for each slot
    before = read_map(spark, path)
    rows = before.collect() if before is not None else []
    old = {r["virtual_slot"]: r["shard"] for r in rows}
    new = edited(old, now, shards) if rows else dealt(now, shards)
    if rows and new == old and now == {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in rows}:
        return before
    version = 1 + max(_numbers(spark, path), default=0)
    held: dict[int, int] = {}
    out = []
    for slot in sorted(new):
        shard, (n, count) = new[slot], now[slot]
        out.append((slot, shard, n, count, held.get(shard, 0)))
        held[shard] = held.get(shard, 0) + count
    if not out and not rows:
        return spark.createDataFrame([], f"{MAP}, version int")
    beside = f"{path}/_new-{uuid.uuid4().hex}"
    spark.createDataFrame(out, MAP).coalesce(1).write.parquet(beside)
    if not move_new(spark, beside, f"{path}/version={version}"):
        p = spark._jvm.org.apache.hadoop.fs.Path(beside)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        return None
    return read_map(spark, path, version)


def shard_documents(docs: DataFrame, path: str, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Every row's shard and its place there by the map kept at path, with the slot and the version. Law: near equal bytes."""
    spark = docs.sparkSession
    records = spread_hot(materialize(in_slots(docs, slots), "records"), shards, slots)
    slot_map = rebalance(spark, slot_sizes(records), shards, path)
    # the map has at most `slots` rows
    placed = records.join(F.broadcast(slot_map.drop("slot_bytes", "slot_rows")), "virtual_slot")
    w = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rows_before") + F.row_number().over(w) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )
