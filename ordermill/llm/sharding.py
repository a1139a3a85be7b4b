"""Contiguous shards of near-equal bytes from a distributed prefix sum.

Rows are range-partitioned by id; only (id, size, checksum) travels.  The
totals of the partitions (one row per partition) are summed in order, which
gives every partition its offset, and a running sum inside the partition
does the rest.  A row belongs to the shard in whose equal share of the total
its middle byte falls, so shards are contiguous in id order and differ from
the ideal by at most one row at either cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import id_text, staged


def balanced_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless in its shard).

    Null text has no bytes.  Null ids come first; rows with equal ids lie
    side by side, ordered by checksum and size (rows equal in all three are
    interchangeable).  An empty table gives an empty result."""
    spark = docs.sparkSession
    text = F.encode("text", "UTF-8")
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    rows = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")
    totals = sorted(rows.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect())
    offsets, at, seen = [], 0, 0
    for part, size, n in totals:
        offsets.append((part, at, seen))
        at, seen = at + size, seen + n
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, at long, seen long"))
    w = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(starts, "part").select(
        *order, (F.col("at") + F.sum("size").over(w)).alias("upto"),
        (F.col("seen") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1).alias("row"))
    middle = F.col("upto") * 2 - F.col("size")              # twice the middle byte
    share = F.expr(f"cast(({shards}BD * cast(middle as decimal(20))) div {2 * max(at, 1)}BD as int)")
    placed = placed.withColumn("middle", middle).withColumn("shard", F.least(share, F.lit(shards - 1)))
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first")))  # one row per shard
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))
