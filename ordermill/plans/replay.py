"""Replay job: re-send the rows of an order file that were not processed
yet, as messages stamped with an event time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.sources.messages import TIME_HEADER, encode_orders, stamp_event_time


def error_order_ids(errors: DataFrame, source: str = "stream") -> DataFrame:
    """Distinct order ids inside the raw JSON of a source's error rows
    (rows whose JSON is cut or has no id are ignored)."""
    ids = errors.where(F.col("source_system") == source).select(
        F.get_json_object("raw_row", "$.order_id").alias("order_id"))
    return ids.where((F.col("order_id").isNotNull()) & (F.col("order_id") != "")).distinct()


def processed_ids(good: DataFrame | None, errors: DataFrame | None) -> DataFrame | None:
    """Ids already landed (good table) or already rejected (error table).
    A missing table contributes nothing."""
    parts = []
    if good is not None:
        parts.append(good.select("order_id"))
    if errors is not None:
        parts.append(error_order_ids(errors))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def pending_rows(rows: DataFrame, good: DataFrame | None, errors: DataFrame | None) -> DataFrame:
    """Rows whose order_id is in neither the good nor the error table."""
    seen = processed_ids(good, errors)
    return rows if seen is None else rows.join(seen, "order_id", "left_anti")


def to_messages(rows: DataFrame, now: Column | None = None, late_offset_s: int = 0) -> DataFrame:
    """Rows as JSON messages (``value``) carrying event_timestamp = now -
    late_offset_s, ready for a text / Kafka sink."""
    stamped = stamp_event_time(rows, now, late_offset_s)
    return encode_orders(stamped, extra=["event_timestamp"]).select("value", "event_timestamp")


def to_records(messages: DataFrame) -> DataFrame:
    """Messages as keyed records: the order id as key, the JSON as value, the
    event time as header (the columns a Kafka sink takes)."""
    header = F.struct(F.lit(TIME_HEADER).alias("key"),
                      F.col("event_timestamp").cast("binary").alias("value"))
    return messages.select(F.get_json_object("value", "$.order_id").alias("key"), "value",
                           F.array(header).alias("headers"))


def publish(messages: DataFrame, target: str, fmt: str = "text", **options) -> None:
    """Message sink.  'text': one JSON message per line of text files in the
    folder ``target`` (the file source of the stream job reads them as they
    arrive).  Any other format (e.g. kafka with its ``options``; ``target`` is
    the topic) gets keyed records with the event time as header."""
    if fmt == "text":
        messages.select("value").write.mode("append").text(target)
        return
    options = {"topic": target, "includeHeaders": "true"} | options if fmt == "kafka" else {"path": target} | options
    to_records(messages).write.format(fmt).mode("append").options(**options).save()


def run_replay(spark, csv_path: str, out_path: str, good: DataFrame | None,
               errors: DataFrame | None, now: Column | None = None, late_offset_s: int = 0) -> dict:
    """Replay job: rows of an order file whose id was neither landed nor
    rejected are stamped with an event time and published as messages.

    The counters are observed on the write itself.  ``errors_without_id``
    counts the stream's error rows whose message names no order (cut or
    malformed text): such orders are sent again by every replay."""
    from ordermill.schemas import ORDER_COLUMNS
    from ordermill.sources.files import read_csv_strings

    read, sent = Observation("rows"), Observation("sent rows")
    n = F.count(F.lit(1)).alias("n")
    now = F.lit(_dt.datetime.now(_dt.timezone.utc)) if now is None else now
    rows = read_csv_strings(spark, csv_path, ORDER_COLUMNS).observe(read, n)
    pending = pending_rows(rows, good, errors)
    publish(to_messages(pending, now, late_offset_s).observe(sent, n), out_path)
    nameless = 0
    if errors is not None:
        stream = errors.where(F.col("source_system") == "stream")
        order_id = F.coalesce(F.get_json_object("raw_row", "$.order_id"), F.lit(""))
        nameless = stream.where(order_id == "").count()
    total, out = read.get["n"], sent.get["n"]
    return {"rows": total, "sent": out, "skipped": total - out, "errors_without_id": nameless}
