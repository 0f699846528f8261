"""Sharding by fixed virtual slots.

Records hash into thousands of virtual slots whose number never changes.  The
bytes of each slot are added up, and a small versioned table maps every slot to
a shard.  Rebalancing edits that table; records are never hashed anew.  All
steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.llm.base import staged

#: virtual slots; fixed, so the map has the same size for every input
N_SLOTS = 4096


def virtual_slot(*keys: Column, n_slots: int = N_SLOTS) -> Column:
    """The slot of a record: a hash of its keys, null keys included."""
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def slot_sizes(records: DataFrame, slot: str, size: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes and rows of every slot, slots without records included."""
    found = records.groupBy(F.col(slot).alias("slot")).agg(
        F.sum(size).alias("bytes"), F.count("*").alias("rows")
    )
    spark = records.sparkSession
    every = spark.range(n_slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(found, "slot", "left").select(
        "slot", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
    )


def first_map(sizes: DataFrame, n_shards: int) -> DataFrame:
    """Version 1 of the map: the largest slots first, each to the lightest shard.

    One fold over the ``N_SLOTS`` sizes, whatever the number of records.
    """
    fold = f"""
        aggregate(
            slots,
            named_struct('loads', array_repeat(0L, {n_shards}), 'chosen', cast(array() as array<int>)),
            (s, x) -> named_struct(
                'loads', transform(s.loads, (v, i) ->
                    if(i + 1 = array_position(s.loads, array_min(s.loads)), v + x.bytes, v)),
                'chosen', concat(s.chosen,
                    array(cast(array_position(s.loads, array_min(s.loads)) - 1 as int)))
            ),
            s -> s.chosen
        )"""
    listed = sizes.select(
        F.struct((-F.col("bytes")).alias("less"), "slot", "bytes", "rows").alias("x")
    ).agg(F.sort_array(F.collect_list("x")).alias("slots"))
    chosen = listed.withColumn("shards", F.expr(fold))
    return chosen.select(F.explode(F.arrays_zip("slots", "shards")).alias("x")).select(
        F.lit(1).alias("version"), F.col("x.slots.slot").alias("slot"), F.col("x.shards").alias("shard"),
        F.col("x.slots.bytes").alias("bytes"), F.col("x.slots.rows").alias("rows"),
    )


def grown_map(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version, for one more shard than ``n_shards``.

    Slots move into the new shard only: each shard gives up what it has above
    the new mean, small slots first.
    """
    by_shard = Window.partitionBy("shard")
    small_first = by_shard.orderBy("bytes", "slot")
    total = slot_map.agg(F.sum("bytes").alias("__total"))
    given = F.sum("bytes").over(small_first)
    spare = F.sum("bytes").over(by_shard) - F.col("__total") / (n_shards + 1)
    moves = (F.col("bytes") > 0) & (given <= spare)
    return slot_map.join(F.broadcast(total)).select(
        (F.col("version") + 1).alias("version"), "slot",
        F.when(moves, F.lit(n_shards)).otherwise(F.col("shard")).cast("int").alias("shard"),
        "bytes", "rows",
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add one version to the stored map; earlier versions stay."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the newest unless given."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version)


def with_shard(records: DataFrame, slot_map: DataFrame, slot: str = "virtual_slot") -> DataFrame:
    """Look the shard of every record up in one version of the map.

    The map has ``N_SLOTS`` rows, so a copy for each task is always small.
    """
    small = slot_map.select(F.col("slot").alias(slot), "shard")
    return records.drop("shard").join(F.broadcast(small), slot)


def write_shards(records: DataFrame, slot_map: DataFrame, path: str) -> None:
    """The records as one folder of Parquet files for each shard."""
    with_shard(records, slot_map).write.partitionBy("shard").parquet(path)


def shard_documents(
    docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Shard and place of every document, and the map with both its versions.

    Size is the UTF-8 bytes of the text plus 8, so a null text counts 8; its
    checksum is that of the empty text.  A record hashes by key and checksum,
    so null or repeated keys with different texts spread over all slots; rows
    that repeat key and text share a slot.  ``slot`` is the gapless place
    within the shard, in the order of virtual slot, key and checksum.  Shards
    come near equal in bytes.  An empty table gives no rows and a map in which
    every slot is empty.  Other columns of ``docs`` are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("key"), (F.octet_length(content) + F.lit(8)).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    records = staged(
        narrow.withColumn("virtual_slot", virtual_slot(F.col("key"), F.col("text_crc32"), n_slots=n_slots)),
        "slots",
    )
    first = staged(first_map(slot_sizes(records, "virtual_slot", "size", n_slots), n_shards), "slot-map")
    grown = grown_map(first, n_shards)
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    places = first.select(
        F.col("slot").alias("virtual_slot"), "shard",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__offset"),
    ).join(grown.select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("next_shard")), "virtual_slot")
    inside = Window.partitionBy("virtual_slot").orderBy("key", "text_crc32", "size")
    placed = (
        records.withColumn("__place", F.row_number().over(inside) - 1)
        .join(F.broadcast(places), "virtual_slot")
        .select(
            F.col("key").alias(key), "size", "text_crc32", "shard",
            (F.col("__offset") + F.col("__place")).cast("long").alias("slot"),
            "virtual_slot", "next_shard",
        )
    )
    return placed, first.unionByName(grown)
