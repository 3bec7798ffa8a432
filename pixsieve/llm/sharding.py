"""Shards by fixed virtual slots.

Every row hashes into one of a fixed number of virtual slots. Bytes are added up per slot, and a
versioned map says which shard holds a slot. Version 1 deals the slots out in turn. Rebalancing
edits it: of every shard the largest slots stay as long as they fit into an equal share; the
slots beyond it go, largest first, to the shard with the fewest bytes so far. Rows never move
between slots, so a new version moves whole slots and nothing is hashed again.

All of it is DataFrame work. Only narrow columns are shuffled. Places in a shard come from row numbers
inside each slot plus the sizes of the shard's slots before it, so no task holds a shard.

Edge cases: a null text has no bytes, its row the fixed 8; a null ``doc_id`` hashes like any value;
repeated rows stay and get places of their own, ties of ``doc_id`` in any order; an empty table gives an
empty result and a version 2 equal to version 1; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pixsieve.session import write_table

VIRTUAL_SLOTS = 8192
ROW_BYTES = 8


def virtual_slot(key: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Version 1: (version, virtual_slot, shard), slots dealt out in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(1).alias("version"), slot.alias("virtual_slot"), (slot % shards).cast("int").alias("shard"))


def rebalanced(slot_map: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """The next version of ``slot_map`` for the bytes per slot in ``load`` (virtual_slot, bytes).

    ``slot_map`` holds one version. The work is bounded by the number of slots.
    """
    sized = slot_map.join(load, "virtual_slot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("long")))
    share = sized.agg((F.sum("bytes") / shards).alias("share"))
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    held = sized.join(F.broadcast(share)).withColumn("stays", F.sum("bytes").over(largest_first) <= F.col("share"))
    kept = held.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(kept, "shard", "left").agg(
        F.array_sort(F.collect_list(F.struct("shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes")))).alias("loads")
    )
    moving = held.filter("not stays").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot"))).alias("moving")
    )
    start = F.struct(
        F.transform("loads", lambda x: x["bytes"]).alias("bytes"),
        F.array().cast("array<int>").alias("dealt"),
    )

    def deal(state: Column, slot: Column) -> Column:
        to = F.array_position(state["bytes"], F.array_min(state["bytes"])) - 1
        bytes_ = F.transform(state["bytes"], lambda b, i: F.when(i == to, b - slot["less"]).otherwise(b))
        return F.struct(bytes_.alias("bytes"), F.concat(state["dealt"], F.array(to.cast("int"))).alias("dealt"))

    dealt = (
        moving.join(F.broadcast(loads))
        .select(F.arrays_zip(F.transform("moving", lambda x: x["virtual_slot"]).alias("virtual_slot"), F.aggregate("moving", start, deal)["dealt"].alias("shard")).alias("both"))
        .select(F.explode("both").alias("both"))
        .select(F.col("both.virtual_slot").alias("virtual_slot"), F.col("both.shard").alias("shard"))
    )
    version = (F.col("version") + 1).alias("version")
    edited = held.select(version, "virtual_slot", F.col("shard").alias("held")).join(dealt, "virtual_slot", "left")
    return edited.select("version", "virtual_slot", F.coalesce("shard", "held").alias("shard"))


def shard_rows(rows: DataFrame, shards: int, key: str = "doc_id", size: str = "size") -> tuple[DataFrame, DataFrame]:
    """(rows with ``virtual_slot``, ``shard`` and ``slot``, the stored map with all versions).

    ``slot`` is the row's place in its shard, gapless from 0.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("virtual_slot", virtual_slot(F.col(key)))
    load = write_table(placed.groupBy("virtual_slot").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")), "slot-load")
    first = first_map(spark, shards)
    slot_map = write_table(first.unionByName(rebalanced(first, load, shards)), "slot-map")
    now = slot_map.filter(F.col("version") == 2).drop("version")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    begins = now.join(load, "virtual_slot").withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).select("virtual_slot", "shard", "begin")
    inside = Window.partitionBy("virtual_slot").orderBy(key)
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1)
    out = numbered.join(F.broadcast(begins), "virtual_slot").withColumn("slot", (F.col("begin") + F.col("place")).cast("long"))
    return out.drop("begin", "place"), slot_map


def sharded_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per document: its size, checksum, shard and place; sizes of shards near equal."""
    data = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    narrow = docs.select(
        "doc_id", (F.octet_length(data).cast("long") + ROW_BYTES).alias("size"), F.crc32(data).alias("text_crc32")
    )
    out, _ = shard_rows(narrow, shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"), "virtual_slot",
    )
