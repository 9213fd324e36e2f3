"""Sharding over fixed virtual slots: records hash into slots, a versioned map gives each slot a shard.

Law ``bytes``: the map is made so that shards have nearly equal bytes. Adding or removing shards, or a drift of sizes,
edits the map: as few slots as possible move and the old version stays readable.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tillwise.llm.common import new_path, stored

DRIFT = 0.1   # of a shard's fair share: a stored map is edited when the fullest shard is further above the emptiest
SLOTS = 4096  # virtual slots: bounds the map and what the driver sees of the data


def slot_of(id_col: Column, text: Column, slots: int = SLOTS) -> Column:
    """Slot of a record by its id; records without one by their text, so that they do not share a slot."""
    return F.pmod(F.when(id_col.isNotNull(), F.xxhash64(id_col)).otherwise(F.xxhash64(text)), F.lit(slots)).cast("int")


def new_map(slot_bytes: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slots by falling bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda s: (-slot_bytes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + slot_bytes.get(slot, 0), shard))
    return out


def edited_map(old: dict[int, int], slot_bytes: dict[int, int], shards: int) -> dict[int, int]:
    """The map after a change of the shard count or of sizes: slots of shards that are gone move first, then the
    fullest shard gives to the emptiest as long as that lowers the larger of the two. Only new shards are given slots
    where there are any."""
    new = sorted(set(range(shards)) - set(old.values())) or list(range(shards))
    out, load = dict(old), [0] * shards
    for slot, shard in old.items():
        if shard < shards:
            load[shard] += slot_bytes.get(slot, 0)
    for slot in sorted((s for s, k in old.items() if k >= shards), key=lambda s: (-slot_bytes.get(s, 0), s)):
        out[slot] = min(range(shards), key=lambda k: (load[k], k))
        load[out[slot]] += slot_bytes.get(slot, 0)
    members: dict[int, list[int]] = {k: [] for k in range(shards)}
    for slot in sorted(out, key=lambda s: (slot_bytes.get(s, 0), s)):
        members[out[slot]].append(slot)
    for _ in range(len(out)):
        full, empty = max(range(shards), key=lambda k: (load[k], -k)), min(new, key=lambda k: (load[k], k))
        gap = load[full] - load[empty]
        fitting = [s for s in members[full] if 0 < slot_bytes.get(s, 0) < gap]
        if not fitting:
            break
        moved = min(fitting, key=lambda s: (abs(gap / 2 - slot_bytes.get(s, 0)), s))
        members[full].remove(moved)
        members[empty].append(moved)
        out[moved] = empty
        load[full] -= slot_bytes.get(moved, 0)
        load[empty] += slot_bytes.get(moved, 0)
    return out


def write_map(spark: SparkSession, mapping: dict[int, int], version: int, path: str) -> None:
    """Append one version of the map to the table at ``path``."""
    rows = [(version, slot, shard) for slot, shard in sorted(mapping.items())]
    spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the latest by default."""
    table = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    return table.where(F.col("version") == (F.lit(version) if version is not None else table.agg(F.max("version")).scalar()))


def stored_map(spark: SparkSession, path: str, shards: int) -> tuple[int, int, dict[int, int]] | None:
    """Of the versions at ``path``: the last number, and the number and slots of the last one for ``shards`` shards, or of the
    last one at all. None where nothing is stored. A map has a row per virtual slot."""
    try:
        table = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    versions = table.groupBy("version").agg((F.max("shard") + 1).alias("shards")).collect()
    if not versions:
        return None
    last = max(v["version"] for v in versions)
    chosen = max((v["version"] for v in versions if v["shards"] == shards), default=last)
    return last, chosen, {r["virtual_slot"]: r["shard"] for r in table.where(F.col("version") == chosen).collect()}


def kept_map(spark: SparkSession, path: str, slot_bytes: dict[int, int], shards: int, slots: int, base: dict[int, int] | None = None) -> tuple[int, dict[int, int]]:
    """Version and slots of the map for ``shards`` shards: the stored one, edited and appended as a new version where the sizes
    (by more than ``DRIFT``) or the number of shards ask for it. ``base``: what to edit if no version for as many shards is stored."""
    found = stored_map(spark, path, shards)
    if found is None:
        version, mapping = 1, new_map(slot_bytes, shards, slots)
    else:
        last, version, old = found
        if set(old) != set(range(slots)):
            raise ValueError(f"the map at {path} has {len(old)} slots, not {slots}")
        fits = max(old.values()) + 1 == shards
        load = [0] * (max(old.values()) + 1)
        for slot, shard in old.items():
            load[shard] += slot_bytes.get(slot, 0)
        if fits and max(load) - min(load) <= DRIFT * sum(load) / shards:
            return version, old
        mapping = edited_map(old if fits or base is None else base, slot_bytes, shards)
        if fits and mapping == old:
            return version, old
        version = last + 1
    write_map(spark, mapping, version, path)
    return version, mapping


def assign(docs: DataFrame, shards: int = 16, grow_to: int | None = None, slots: int = SLOTS, map_path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, slot, map_version`` and ``moved_shard`` for every row.

    ``size``: UTF-8 bytes plus 1 (null text: 1). ``slot``: the record's place in its shard, gapless from 0, by virtual
    slot and id. ``moved_shard``: the shard after the map was edited for ``grow_to`` shards. Repeated rows have places of
    their own; an empty table gives no rows. Equal texts have slots of their own, as the id decides, so they may lie in
    different shards. If ``map_path`` holds a map, it is read and edited, and an edit is appended as the next version; a call
    that changes nothing appends nothing. A record larger than a shard's fair share can't be split and fills its shard alone.
    """
    spark = docs.sparkSession
    text = docs[text_col]
    records = stored(docs.select(docs[id_col].alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                                 F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
                                 slot_of(docs[id_col], text, slots).alias("virtual_slot")), "shard-records")
    per_slot = {r["virtual_slot"]: (r["bytes"], r["n"]) for r in records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}  # at most ``slots`` rows
    slot_bytes = {s: b for s, (b, _) in per_slot.items()}
    path = map_path or new_path(spark, "slot-map")
    version, first = kept_map(spark, path, slot_bytes, shards, slots)
    grown_version, _ = kept_map(spark, path, slot_bytes, grow_to or shards + 1, slots, base=first)
    starts, filled = [], [0] * shards
    for slot in range(slots):
        starts.append((slot, filled[first[slot]]))
        filled[first[slot]] += per_slot.get(slot, (0, 0))[1]
    current = read_map(spark, path, version).select("virtual_slot", "shard", F.col("version").alias("map_version"))
    grown = read_map(spark, path, grown_version).select("virtual_slot", F.col("shard").alias("moved_shard"))
    table = spark.createDataFrame(starts, "virtual_slot int, before long").join(current, "virtual_slot").join(grown, "virtual_slot")
    # The key of the window is the virtual slot: one of ``slots`` even parts of the ids, however the texts are spread.
    place = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (records.withColumn("place", place).join(F.broadcast(table), "virtual_slot")  # ``slots`` rows
            .select("doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("before") + F.col("place") - 1).alias("slot"),
                    "map_version", "moved_shard"))
