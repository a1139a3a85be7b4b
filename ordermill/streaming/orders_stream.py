"""Order message stream: parse, validate, route bad and too-late rows to the
error table, drop duplicates per (order_id, event-time window), and write
both outputs from one micro-batch.

Design (Spark-first):
  * the validation is the batch operator, unchanged; arrival time is the
    micro-batch clock (or a column of the source);
  * rows more than window + lateness seconds behind their arrival become
    error rows *before* windowing, so nothing is dropped silently;
  * the watermark runs on least(event time, arrival time): an event stamped
    in the future cannot push the watermark ahead of on-time rows;
  * duplicates: dropDuplicatesWithinWatermark on (order_id, window start):
    one copy per key and window, state expires with the watermark; or, with
    ``early_s``, one copy per firing pane of the window (see panes), numbered;
  * one branch (the source is read and parsed once per micro-batch); good
    and error rows are split inside foreachBatch; each batch overwrites its
    own batch_id= folder, so a replayed batch after a restart rewrites
    instead of appending twice.
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from ordermill.functions.dates import window_start
from ordermill.operators import validate as V
from ordermill.schemas import ERRORS, ORDERS_STREAM
from ordermill.sources.files import enforce_not_null, read_table, table_exists
from ordermill.sources.messages import decode_orders
from ordermill.sources.snapshots import SnapshotTable
from ordermill.streaming.panes import PANE_FIELDS, SECOND, with_panes

log = logging.getLogger(__name__)

GOOD, BAD = "good", "bad"
COUNTERS = "validated_messages"
FOLDERS_AT_MOST = 16             # folders of a partition of a snapshot sink before they are merged
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def orders_stream(messages: DataFrame, window_s: int = 60, lateness_s: int = 300,
                  arrival: Column | None = None, early_s: int | None = None) -> DataFrame:
    """messages: ``value`` (JSON text) and ``arrival_ts``.  Returns rows of
    (kind, good struct, error struct) ready for ``write_batch``.

    One branch: each message is decoded and validated once per micro-batch.
    A single dropDuplicatesWithinWatermark keeps one good row per
    (order_id, event-time window) and one error row per distinct message
    (error_id; a redelivered bad message is the same error, as in the
    insert-only error merge of the batch path).  Error rows carry their
    arrival time as watermark time, so they are never behind the watermark
    and their state expires after the delay.  With ``early_s`` the good rows
    are those that open a pane, and carry its number and firing.
    """
    arrival = F.col("arrival_ts") if arrival is None else arrival
    decoded = decode_orders(messages.withColumn("arrival_ts", arrival))
    checked = V.validate_orders(decoded, "stream", raw=F.col("value"), arrival_ts=F.col("arrival_ts"),
                                window_s=window_s, lateness_s=lateness_s)
    ok = F.col("error_reason").isNull()
    keyed = checked.observe(COUNTERS, *V.counters()).withColumns({
        "_wm": F.when(ok, F.least("event_timestamp", "arrival_ts")).otherwise(F.col("arrival_ts")),
        "_window_start": F.when(ok, window_start(F.col("event_timestamp"), window_s)),
        "_error_id": F.when(~ok, F.md5(F.col("raw_row"))),
    })
    keyed = keyed.withWatermark("_wm", f"{window_s + lateness_s} seconds")
    if early_s is None:
        kept = keyed.dropDuplicatesWithinWatermark(["order_id", "_window_start", "_error_id"])
    else:
        kept = _paned(keyed, window_s, early_s)
    good_cols = {"source_system": F.lit("stream"), "ingestion_timestamp": F.col("arrival_ts")}
    good_struct = F.struct(*[good_cols.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                             for f in good_schema(early_s).fields])
    bad_struct = F.struct(*[c.cast(f.dataType).alias(f.name) for c, f in zip(
        [F.col("_error_id"), F.substring("raw_row", 1, V.STREAM_RAW_MAX),
         F.substring("error_reason", 1, V.REASON_MAX), F.lit("stream"), F.col("arrival_ts")],
        ERRORS.fields)])
    return kept.select(F.when(ok, F.lit(GOOD)).otherwise(F.lit(BAD)).alias("kind"),
                       F.when(ok, good_struct).alias("good"),
                       F.when(~ok, bad_struct).alias("bad"))


def good_schema(early_s: int | None) -> StructType:
    """The good sink's columns: the declared ones, and the pane's where there are panes."""
    return ORDERS_STREAM if early_s is None else StructType([*ORDERS_STREAM.fields, *PANE_FIELDS])


def _paned(keyed: DataFrame, window_s: int, early_s: int) -> DataFrame:
    """Good rows that open a pane, and the first row of every rejected message; times
    pass the state operator as microseconds."""
    start = F.unix_micros("_window_start")
    fields = [f.name for f in ORDERS_STREAM.fields if f.name in keyed.columns and f.name != "event_timestamp"]
    slim = keyed.select(*fields, "_wm", "raw_row", "error_reason", "_error_id", start.alias("_start"),
                        F.unix_micros("event_timestamp").alias("_event"), F.unix_micros("arrival_ts").alias("arrival"),
                        (start + window_s * SECOND).alias("window_end"))
    keys = {"_id": F.coalesce("order_id", F.lit("")), "_from": F.coalesce("_start", F.lit(-1)),
            "_error": F.coalesce("_error_id", F.lit(""))}
    # an error is known by its text alone, as in the other mode
    keys["_id"] = F.when(F.col("error_reason").isNull(), keys["_id"]).otherwise(F.lit(""))
    kept = with_panes(slim.withColumns(keys), list(keys), "_wm", early_s)
    return kept.withColumns({"arrival_ts": F.timestamp_micros("arrival"), "event_timestamp": F.timestamp_micros("_event")})


def write_batch(good_path: str, bad_path: str, run_name: str = "0", schema: StructType = ORDERS_STREAM):
    """foreachBatch function: both sinks from one micro-batch, idempotent per
    run and batch id: a replay overwrites its own folder, never another run's; a
    snapshot table knows the batches it holds, and merges partitions of many
    small batches as it goes."""
    def put(rows: DataFrame, path: str, batch_id: int) -> bool:
        table = SnapshotTable(rows.sparkSession, path)
        if table.exists():
            table.append(rows, (run_name, batch_id), FOLDERS_AT_MOST)
            return True
        return False

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = enforce_not_null(batch.where(F.col("kind") == GOOD).select("good.*"), schema)
            bad = enforce_not_null(batch.where(F.col("kind") == BAD).select("bad.*"), ERRORS)
            good_done, bad_done = put(good, good_path, batch_id), put(bad, bad_path, batch_id)
            if not good_done:
                (good.hint("rebalance", "order_date").write.mode("overwrite").option("partitionOverwriteMode", "static")
                 .partitionBy("order_date").parquet(f"{good_path}/batch_id={run_name}-{batch_id}"))
            if not bad_done:
                bad.write.mode("overwrite").parquet(f"{bad_path}/batch_id={run_name}-{batch_id}")
        finally:
            batch.unpersist()
    return run


class RunCounters(StreamingQueryListener):
    """Counters of the order streams of a session, over all their batches:
    messages read, good and bad ones, rows the dedup left out, and rows the
    watermark dropped.  The last must stay 0 (late rows are error rows before
    the watermark sees them); any is logged as an error."""

    def __init__(self):
        self.counts = {"total_rows": 0, "good_rows": 0, "bad_rows": 0,
                       "dropped_as_copies": 0, "dropped_by_watermark": 0}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        seen = progress.observedMetrics.get(COUNTERS)
        if seen is None:
            return
        for name in ("total_rows", "good_rows", "bad_rows"):
            self.counts[name] += seen[name]
        for state in progress.stateOperators:
            self.counts["dropped_by_watermark"] += state.numRowsDroppedByWatermark
            self.counts["dropped_as_copies"] += state.customMetrics.get("numDroppedDuplicateRows", 0)
            if state.numRowsDroppedByWatermark:
                log.error("batch %s: %s rows dropped by the watermark", progress.batchId,
                          state.numRowsDroppedByWatermark)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def check_sink(spark, path: str, schema, must_exist: bool = False) -> None:
    """An existing sink must hold the expected columns with the same types
    (appending other shapes would corrupt it); with must_exist the sink has
    to be there already (created by its DDL)."""
    if not table_exists(spark, path):
        if must_exist:
            raise ValueError(f"sink {path} does not exist")
        return
    table = read_table(spark, path)
    if table is None:  # created, or only batches without rows so far
        return
    have = {f.name: f.dataType for f in table.schema.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"sink {path} does not match the expected schema: {wrong}")


def start(messages: DataFrame, good_path: str, bad_path: str, checkpoint: str,
          window_s: int = 60, lateness_s: int = 300, trigger: dict | None = None,
          sinks_must_exist: bool = False, early_s: int | None = None):
    """Start the stream.  ``trigger`` e.g. {"processingTime": "30 seconds"}
    (how often new messages are taken up) or {"availableNow": True} for a catch-up
    run.  ``early_s``: fire panes, early ones after so many seconds."""
    spark = messages.sparkSession
    stored = SnapshotTable(spark, good_path)
    if early_s is not None and stored.exists() and "pane" not in stored.snapshot()["schema"].names:
        stored.evolve(good_schema(early_s))
    check_sink(spark, good_path, ORDERS_STREAM, sinks_must_exist)
    check_sink(spark, bad_path, ERRORS, sinks_must_exist)
    # Dedup state lives in RocksDB (off-heap, spills to local disk, snapshots
    # to the checkpoint) unless the deployment chose a provider itself.
    key = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBackedStateStoreProvider" in (spark.conf.get(key, None) or "HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)
    # a new checkpoint counts its batches from 0 again: its folders carry its own name
    run_name = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    out = orders_stream(messages, window_s, lateness_s, early_s=early_s)
    w = (out.writeStream.foreachBatch(write_batch(good_path, bad_path, run_name, good_schema(early_s)))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
