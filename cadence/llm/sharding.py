"""Contiguous balanced shards by global byte-size prefix sums.

Rows are ordered by (text hash, key, row number).  A range partitioning on
that order, per-partition totals and their prefix sum give every row the
global offset of its bytes; shard ``s`` takes the rows whose offset lies in
the ``s``-th of equal byte targets.  Equal texts are neighbours, and a group
of equal texts of at most ``KEEP_GROUP`` of a target follows its first row,
so copies share a shard while sizes stay near equal; larger groups are cut.

The row number in the order splits a group that holds a third of all rows
over many range partitions.  Only (key, size, hashes) are shuffled, never
texts, and only one row per partition is summed in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import col, materialise

SHARDS = 16
KEEP_GROUP = 0.01   # of a shard's target


def shards(docs: DataFrame, n_shards: int = SHARDS, text: str = "text", key: str = "doc_id",
           keep_group: float = KEEP_GROUP) -> DataFrame:
    """One row per row of ``docs``: ``key, size`` (UTF-8 bytes plus 1),
    ``text_crc32, law, shard`` (0-based) and ``slot`` (gapless from 0 in each
    shard, contiguous in the global order).

    A NULL text has no bytes and the checksum of none; NULL keys sort first;
    repeated rows get a slot each.  Few rows may leave shards empty.  An
    empty table gives an empty result."""
    body = F.coalesce(col(text), F.lit(""))
    rows = materialise(docs.select(
        col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(col(text)).alias("h"),
        F.monotonically_increasing_id().alias("rid")))
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["h", "key", "rid"]
    ranged = materialise(rows.repartitionByRange(parts, *order)
                         .withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("part").orderBy(*order)
    placed = materialise(
        ranged.withColumn("end", F.sum("size").over(
            inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("row", F.row_number().over(inside) - 1)
        .join(F.broadcast(totals), "part")
        .select(*order, "size", "text_crc32", (F.col("b0") + F.col("end") - F.col("size"))
                .alias("start"), (F.col("r0") + F.col("row")).alias("row")))
    total = placed.agg(F.sum("size")).first()[0] or 0
    target = total / n_shards
    groups = placed.groupBy("h").agg(F.sum("size").alias("bytes"), F.min("start").alias("first"))
    whole = groups.where(F.col("bytes") <= F.lit(keep_group * target))
    cut = placed.join(whole, "h", "left").withColumn(
        "at", F.coalesce("first", "start")).withColumn(
        "shard", F.least(F.floor(F.col("at") / F.lit(max(target, 1e-9))).cast("int"),
                         F.lit(n_shards - 1)))
    cut = materialise(cut.select("key", "size", "text_crc32", "shard", "row"))
    firsts = cut.groupBy("shard").agg(F.min("row").alias("row0"))   # n_shards rows
    return cut.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("row0")).cast("long").alias("slot"))
