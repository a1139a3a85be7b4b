"""Sink reconciliation: duplicates that slip past the stream's dedup (a
replay after a restart, copies stamped in the future) are found, removed
keeping the earliest-seen copy, and the result is confirmed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.dedup import duplicate_keys, reconcile
from ordermill.sources.files import finish_replacement, pending_folder
from ordermill.sources.snapshots import SnapshotTable


def _in_partitions(df: DataFrame, partitions: DataFrame, columns: list[str]) -> DataFrame:
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(partitions[c]) for c in columns])
    return df.join(partitions, same, "left_semi")


def reconcile_sink(spark: SparkSession, path: str, keys=("order_id",),
                   order=("ingestion_timestamp",), partition_by=("batch_id", "order_date")) -> dict:
    """Check, rewrite, confirm.  Returns the duplicate keys before and after.

    Only partitions that lose a copy are rewritten, so a running stream may
    add its batches meanwhile.  Their new rows are written whole to a pending
    folder beside the sink before anything is replaced; a lost run is
    finished by the next one.  No window meets all copies of a key: the copy
    to keep comes from a group limit, the touched partitions from counts.  A
    snapshot table looks only for keys added since its last reconciliation."""
    keys = list(keys)
    table = SnapshotTable(spark, path)
    if table.exists():
        return table.reconcile(list(order))
    parts = [c for c in partition_by if c in spark.read.parquet(path).columns]
    finish_replacement(spark, path, parts)
    table = spark.read.parquet(path)
    twice = duplicate_keys(table, keys)
    before = twice.count()
    if before:
        pending = pending_folder(path)
        copies = table.join(twice.select(*keys), keys, "left_semi")
        reconcile(copies, keys, order).write.parquet(f"{pending}/kept")
        kept = spark.read.schema(table.schema).parquet(f"{pending}/kept")
        rows = table.join(kept.select(*keys), keys, "left_anti")
        if parts:
            have = copies.select(*parts, F.lit(1).alias("n")).unionByName(kept.select(*parts, F.lit(-1).alias("n")))
            lost = have.groupBy(*parts).agg(F.sum("n").alias("n")).where("n > 0").select(*parts)
            lost.write.parquet(f"{pending}/touched")
            touched = spark.read.schema(table.select(*parts).schema).parquet(f"{pending}/touched")
            rows, kept = _in_partitions(rows, touched, parts), _in_partitions(kept, touched, parts)
        rows.unionByName(kept).write.parquet(f"{pending}/rows")
        finish_replacement(spark, path, parts)
    after = duplicate_keys(spark.read.parquet(path), keys).count()
    return {"duplicate_keys_before": before, "duplicate_keys_after": after}
