"""Order validation: one pass computes the first failing check per row.

``validate_orders`` adds typed columns and ``error_reason`` (null = good);
``split`` turns the result into the good rows and the error rows.  The same
reason chain serves the CSV (batch) and the message (stream) path.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import parse
from ordermill.functions.text import raw_line, truncate
from ordermill.schemas import ORDER_COLUMNS, ORDERS_BATCH, ORDERS_STREAM

# Field roles in the order contract.
OPTIONAL_FIELDS = ["campaign_id"]
REQUIRED_FIELDS = [c for c in ORDER_COLUMNS if c not in OPTIONAL_FIELDS]
INT_FIELDS = ["customer_id", "product_id", "region_id", "quantity",
              "delivery_days", "returned_flag", "customer_rating"]
FLOAT_FIELDS = ["unit_price", "discount", "shipping_cost"]
# Checks in the order they are applied (first failure wins).
CAST_ORDER = ["customer_id", "product_id", "region_id", "campaign_id", "quantity",
              "unit_price", "discount", "shipping_cost", "delivery_days",
              "returned_flag", "customer_rating"]

# Error texts.
NOT_OBJECT = "message is not a JSON object"
MISSING = "missing required field(s): "
QTY_NOT_POSITIVE = "quantity must be positive"
BAD_INT = "invalid integer for {}"
BAD_FLOAT = "invalid number for {}"
BAD_DATE = "invalid order_date: expected %Y-%m-%d"
BAD_EVENT_TS = "invalid event_timestamp: expected %Y-%m-%dT%H:%M:%S.%fZ"
TOO_LATE = ("event arrived too late to process: {}s after event_timestamp, exceeds max "
            "allowed lateness of {}s (window={}s + allowed_lateness={}s) -- would otherwise "
            "be silently dropped by the window")

REASON_MAX = 500
STREAM_RAW_MAX = 2000


def _missing_reason(cols: list[str]) -> Column:
    names = F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(f"'{c}'")) for c in cols]))
    # the list of names is made only for rows that lack one
    return F.when(reduce(or_, [F.col(c).isNull() for c in cols]),
                  F.concat(F.lit(MISSING + "["), F.array_join(names, ", "), F.lit("]")))


def _late_reason(lateness_us: Column, window_s: int, lateness_s: int) -> Column:
    max_s = window_s + lateness_s
    head, tail = TOO_LATE.split("{}s after", 1)
    msg = F.concat(F.lit(head), (lateness_us / 1_000_000).cast("bigint").cast("string"),
                   F.lit("s after" + tail.format(max_s, window_s, lateness_s)))
    return F.when(lateness_us > F.lit(max_s * 1_000_000), msg)


def validate_orders(df: DataFrame, source: str = "batch", *, raw: Column | None = None,
                    arrival_ts: Column | None = None, window_s: int = 60,
                    lateness_s: int = 300) -> DataFrame:
    """Type and check text order rows.

    df: the order fields as text (CSV columns, or decoded message fields;
    stream input also has ``event_timestamp`` and ``_not_object``).
    raw: the raw text kept for the error table (default: the CSV line).
    arrival_ts: when the message arrived; the stream path routes rows more
    than window + lateness seconds behind it to the errors.
    Returns the input columns (text fields replaced by typed ones) plus
    ``raw_row`` and ``error_reason``.
    """
    stream = source == "stream"
    raw = raw_line(ORDER_COLUMNS) if raw is None else raw
    texts = ORDER_COLUMNS + (["event_timestamp"] if stream else [])
    text = df.withColumn("raw_row", raw).withColumns({c: parse.blank_to_null(c) for c in texts})

    parsers = {c: parse.strict_long for c in INT_FIELDS}
    parsers.update({c: parse.strict_double for c in FLOAT_FIELDS})
    parsers["campaign_id"] = parse.lenient_long
    parsers["order_date"] = parse.strict_date
    if stream:
        parsers["event_timestamp"] = parse.strict_event_ts
    # Parsed values get their own projection (each parse runs once); the
    # checks below refer to them by name, which keeps the plan small.
    tmp = {c: f"__typed_{c}" for c in parsers}
    typed = text.withColumns({tmp[c]: fn(c) for c, fn in parsers.items()})
    t = lambda c: F.col(tmp[c])
    bad = lambda c: F.col(c).isNotNull() & t(c).isNull()

    checks: list[Column] = []
    if stream:
        checks.append(F.when(F.col("_not_object"), F.lit(NOT_OBJECT)))
    checks.append(_missing_reason(REQUIRED_FIELDS))
    for c in CAST_ORDER:
        msg = BAD_FLOAT if c in FLOAT_FIELDS or c == "campaign_id" else BAD_INT
        checks.append(F.when(bad(c), F.lit(msg.format(c))))
        if c == "quantity":
            checks.append(F.when(t("quantity") <= 0, F.lit(QTY_NOT_POSITIVE)))
    checks.append(F.when(bad("order_date"), F.lit(BAD_DATE)))
    if stream:
        checks.append(F.when(t("event_timestamp").isNull(), F.lit(BAD_EVENT_TS)))
        if arrival_ts is not None:
            lateness_us = F.unix_micros(arrival_ts) - F.unix_micros(t("event_timestamp"))
            checks.append(_late_reason(lateness_us, window_s, lateness_s))
    checked = typed.withColumn("error_reason", F.coalesce(*checks))
    out = checked.withColumns({c: F.col(n) for c, n in tmp.items()}).drop(*tmp.values())
    # The validated record leaves through a generator: predicates on it (the
    # good / error split) cannot be pushed below a Generate, so every field
    # is parsed once per row instead of once per reference in each filter.
    return out.select(F.inline(F.array(F.struct(*out.columns))))


def good_rows(validated: DataFrame, source: str = "batch",
              ingestion_ts: Column | None = None) -> DataFrame:
    """Rows that passed, typed to the raw table schema, stamped with the
    source and the ingestion time (an argument so runs are reproducible)."""
    schema = ORDERS_STREAM if source == "stream" else ORDERS_BATCH
    ingestion_ts = F.current_timestamp() if ingestion_ts is None else ingestion_ts
    g = validated.where(F.col("error_reason").isNull()).withColumns({
        "source_system": F.lit(source), "ingestion_timestamp": ingestion_ts})
    return g.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def error_rows(validated: DataFrame, source: str = "batch",
               logged_at: Column | None = None) -> DataFrame:
    """Rows that failed, in the error table shape.  error_id is the md5 of
    the full raw text; the stream path stores at most 2000 chars of it."""
    logged_at = F.current_timestamp() if logged_at is None else logged_at
    raw = F.col("raw_row")
    return validated.where(F.col("error_reason").isNotNull()).select(
        F.md5(raw).alias("error_id"),
        (truncate(raw, STREAM_RAW_MAX) if source == "stream" else raw).alias("raw_row"),
        truncate("error_reason", REASON_MAX).alias("error_reason"),
        F.lit(source).alias("source_system"),
        logged_at.cast("timestamp").alias("logged_at"),
    )


def split(validated: DataFrame, source: str = "batch", now: Column | None = None):
    """(good, errors): every row lands in exactly one of the two."""
    return good_rows(validated, source, now), error_rows(validated, source, now)


def counters() -> list[Column]:
    """The run counters of validated rows: total, good and bad."""
    bad = F.col("error_reason").isNotNull()
    return [F.count(F.lit(1)).alias("total_rows"), F.count_if(~bad).alias("good_rows"),
            F.count_if(bad).alias("bad_rows")]


def validation_counts(validated: DataFrame) -> DataFrame:
    """Run counters in one aggregate."""
    return validated.agg(*counters())


def coerce_dimension(df: DataFrame, spec: dict) -> DataFrame:
    """Reference-data load: unparseable numbers and dates become null (no
    error rows), then rows without a key are dropped."""
    casts = {}
    for c in spec.get("int_cols", []):
        # integer text stays integer (a double keeps only 53 bits); "3.0" counts as 3
        d = parse.strict_double(c)
        casts[c] = F.coalesce(parse.strict_long(c), F.when(d == F.floor(d), d.try_cast("bigint")))
    for c in spec.get("float_cols", []):
        casts[c] = parse.strict_double(c)
    for c in spec.get("date_cols", []):
        casts[c] = F.coalesce(parse.strict_date(c), F.try_to_date(F.col(c)))
    return df.withColumns(casts).na.drop(subset=spec["key"])
