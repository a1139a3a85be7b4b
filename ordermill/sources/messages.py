"""Order messages: JSON text in, JSON text out, batch or streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import ORDER_COLUMNS, all_strings

MESSAGE_FIELDS = ORDER_COLUMNS + ["source_system", "event_timestamp"]


# Fixed value: the record header that holds the event time; and the column it is read into.
TIME_HEADER, HEADER_TIME = "event_timestamp", "_header_event_timestamp"
RECORD_SCHEMA = "key string, value string, headers array<struct<key string, value binary>>"

# Fixed value: the replay stamp has milliseconds.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def encode_orders(rows: DataFrame, extra=(), source_system: str = "stream") -> DataFrame:
    """Add ``value``: the row as a JSON object of text (nulls kept as null)."""
    cols = [F.col(c).cast("string").alias(c) for c in ORDER_COLUMNS]
    cols.append(F.lit(source_system).alias("source_system"))
    cols += [F.col(c).cast("string").alias(c) for c in extra]
    return rows.withColumn("value", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def stamp_event_time(rows: DataFrame, now: Column | None = None, late_offset_s: int = 0) -> DataFrame:
    """Replay stamp: event_timestamp = now - offset, in the message format
    (optionally moved back to simulate late data)."""
    now = F.current_timestamp() if now is None else now
    ts = now - F.make_interval(secs=F.lit(late_offset_s)) if late_offset_s else now
    return rows.withColumn("event_timestamp", F.date_format(ts, STAMP_FORMAT))


def decode_orders(messages: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON text into text columns; anything that is not one JSON object
    keeps its text and sets ``_not_object``.  One parse: the text in brackets
    must be an array of exactly one object.  An event time that came as a
    record header (``HEADER_TIME``) goes before the payload's."""
    schema = "array<" + all_strings(MESSAGE_FIELDS).simpleString() + ">"
    text = F.col(value).cast("string")
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), schema, {"allowSingleQuotes": "false"})
    out = messages.withColumn("_all", parsed).withColumn("_msg", F.when(F.size("_all") == 1, F.get("_all", F.lit(0))))
    fields = {f: F.col("_msg")[f] for f in MESSAGE_FIELDS}
    if HEADER_TIME in messages.columns:
        header = F.when(F.col(HEADER_TIME) != "", F.col(HEADER_TIME))
        fields["event_timestamp"] = F.coalesce(header, fields["event_timestamp"])
    return out.select(*[c for c in messages.columns], *[v.alias(k) for k, v in fields.items()],
                      (F.col("_msg").isNull() | ~F.coalesce(F.ltrim(text).startswith("{"), F.lit(False)))
                      .alias("_not_object"))


def records_as_messages(records: DataFrame) -> DataFrame:
    """Keyed records (``value`` and ``headers``, an array of key and value, as a
    Kafka source gives them) as messages: ``value`` as text and the event time
    of the last header of that name."""
    named = F.filter("headers", lambda h: h["key"] == TIME_HEADER)
    time = F.get(F.transform(named, lambda h: h["value"].cast("string")), F.size(named) - 1)
    keep = [c for c in records.columns if c not in ("value", "headers")]
    return records.select(*keep, F.col("value").cast("string").alias("value"), time.alias(HEADER_TIME))


def read_message_stream(spark: SparkSession, path: str, fmt: str = "text", **options) -> DataFrame:
    """Unbounded source of messages: one message per line of new files in
    ``path`` (or format='kafka' with its options when the connector is on the
    classpath).  Adds ``arrival_ts``: the time the micro-batch read it."""
    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path) if fmt != "kafka" else reader.load()
    if "value" not in df.columns:
        raise ValueError("message source must provide a 'value' column")
    return df.withColumn("arrival_ts", F.current_timestamp())


def read_record_stream(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Unbounded source of keyed records: files of ``RECORD_SCHEMA`` in ``path``
    (what ``replay.publish`` writes in that format), or fmt='kafka' with its
    options.  Each becomes a message with its event-time header, ``arrival_ts``
    and ``_offset``, its place in the source (topic, partition and offset, or the file)."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        records = reader.options(includeHeaders="true", **options).load()
        place = F.struct("topic", "partition", "offset")
    else:
        records = reader.schema(RECORD_SCHEMA).options(**options).load(path)
        place = F.struct(F.col("_metadata.file_path").alias("file"))
    return records_as_messages(records.withColumns({"_offset": place, "arrival_ts": F.current_timestamp()}))
