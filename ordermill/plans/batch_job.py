"""Batch ingest: order file -> validate -> dedup (last row wins) -> upsert
into the raw orders table; error rows insert-only; reference tables coerced
and upserted.  One lazy plan per sink; only counters reach the driver.

A run has one clock: all its rows carry the same load time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.operators.dedup import dedup
from ordermill.schemas import ERRORS, ORDER_COLUMNS, ORDERS_BATCH, RAW_TABLES, REFERENCE_TABLES, SNAPSHOT_KEYS, coercion_spec
from ordermill.session import prepare
from ordermill.sources.files import create_tables, enforce_not_null, insert_new, read_csv_strings, read_table, upsert_table


def run_clock() -> Column:
    return F.lit(_dt.datetime.now(_dt.timezone.utc))


def create_raw(spark: SparkSession, raw_root: str, snapshots: bool = False) -> list[str]:
    """Create the raw tables that are missing; their names.  With ``snapshots``
    they are snapshot tables, those that the stream writes too."""
    return create_tables(spark, raw_root.rstrip("/"), RAW_TABLES, SNAPSHOT_KEYS if snapshots else None)


def ingest_orders(spark: SparkSession, csv_path: str, raw_root: str,
                  clock: Column | None = None) -> dict:
    """Load one order file.  The good and the error rows are two plans over
    the file (nothing is kept on executor disks between them); the counters
    are observed while the error rows are written."""
    prepare(spark)
    clock = run_clock() if clock is None else clock
    validated = V.validate_orders(read_csv_strings(spark, csv_path, ORDER_COLUMNS), "batch")
    good = dedup(validated.where(F.col("error_reason").isNull()), ["order_id"], ["_pos"], keep="last")
    upsert_table(spark, enforce_not_null(V.good_rows(good, "batch", clock), ORDERS_BATCH),
                 f"{raw_root}/orders_batch", ["order_id"], partition_by="order_date")
    seen = Observation("order rows")
    errors = V.error_rows(validated.observe(seen, *V.counters()), "batch", clock)
    insert_new(spark, enforce_not_null(errors, ERRORS), f"{raw_root}/orders_batch_errors", ["error_id"])
    return seen.get


def ingest_reference(spark: SparkSession, name: str, csv_path: str, raw_root: str,
                     clock: Column | None = None) -> dict:
    """Reference table: text -> coerced types -> rows with a key -> upsert by key.
    A key repeated inside one file is an error (a MERGE would reject it)."""
    prepare(spark)
    clock = run_clock() if clock is None else clock
    schema = REFERENCE_TABLES[name]
    spec = coercion_spec(schema)
    cols = [f.name for f in schema.fields if f.name != "ingestion_timestamp"]
    read, kept = Observation("rows"), Observation("kept rows")
    rows = read_csv_strings(spark, csv_path, cols).drop("_pos").observe(read, F.count(F.lit(1)).alias("n"))
    coerced = V.coerce_dimension(rows, spec).observe(kept, F.count(F.lit(1)).alias("n"))
    typed = enforce_not_null(coerced.withColumn("ingestion_timestamp", clock), schema)
    upsert_table(spark, typed, f"{raw_root}/{name}", spec["key"])
    loaded = read_table(spark, f"{raw_root}/{name}", schema).count()  # from the file footers
    n, k = read.get["n"], kept.get["n"]
    return {"rows": n, "kept": k, "dropped_missing_key": n - k, "table_rows": loaded}
