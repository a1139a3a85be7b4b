"""Declared table schemas of the raw layer (typed raw tables, error tables,
dimensions).  Integers are 64-bit, money is double, flags are 0/1 integers."""

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, L, D, DT, TS = StringType(), LongType(), DoubleType(), DateType(), TimestampType()

# The order fields as they arrive (CSV header / message keys), in file order.
ORDER_FIELDS = [
    ("order_id", S), ("customer_id", L), ("product_id", L), ("region_id", L),
    ("campaign_id", L), ("order_date", DT), ("quantity", L), ("unit_price", D),
    ("discount", D), ("shipping_cost", D), ("payment_method", S), ("delivery_days", L),
    ("returned_flag", L), ("order_status", S), ("warehouse_region", S),
    ("customer_rating", L), ("customer_city", S), ("customer_state", S),
]
ORDER_COLUMNS = [n for n, _ in ORDER_FIELDS]

# The columns, types and NOT NULL marks of the raw tables.
ORDERS_BATCH = _s(*[(n, t, n != "order_id") for n, t in ORDER_FIELDS],
                  ("source_system", S, True), ("ingestion_timestamp", TS, True))

ORDERS_STREAM = _s(*[(n, t, n != "order_id") for n, t in ORDER_FIELDS],
                   ("source_system", S, True), ("event_timestamp", TS, True),
                   ("ingestion_timestamp", TS, True))

ERRORS = _s(("error_id", S, False), ("raw_row", S, True), ("error_reason", S, True),
            ("source_system", S, True), ("logged_at", TS, True))

CUSTOMERS = _s(("customer_id", L, False), ("customer_name", S, True), ("age_group", S, True),
               ("gender", S, True), ("city", S, True), ("state", S, True),
               ("membership_type", S, True), ("customer_segment", S, True),
               ("annual_income_group", S, True), ("signup_date", DT, True),
               ("ingestion_timestamp", TS, True))

PRODUCTS = _s(("product_id", L, False), ("category", S, True), ("subcategory", S, True),
              ("brand", S, True), ("season_tag", S, True), ("mrp", D, True),
              ("profit_margin_pct", D, True), ("supplier_name", S, True),
              ("stock_level", L, True), ("ingestion_timestamp", TS, True))

CAMPAIGNS = _s(("campaign_id", L, False), ("campaign_name", S, True),
               ("expected_performance", S, True), ("ingestion_timestamp", TS, True))


def all_strings(columns) -> StructType:
    """Schema that reads every column as text (no inference)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def coercion_spec(schema: StructType) -> dict:
    """How text is coerced to a reference table: its key (the fields that may
    not be null) and its integer, float and date fields."""
    named = {kind: [f.name for f in schema.fields if isinstance(f.dataType, kind)]
             for kind in (LongType, DoubleType, DateType)}
    return {"key": [f.name for f in schema.fields if not f.nullable], "int_cols": named[LongType],
            "float_cols": named[DoubleType], "date_cols": named[DateType]}


REFERENCE_TABLES = {"customers": CUSTOMERS, "products": PRODUCTS, "campaigns": CAMPAIGNS}

# The raw layer: table -> (schema, partition columns).
RAW_TABLES = {
    "orders_batch": (ORDERS_BATCH, ["order_date"]),
    "orders_stream": (ORDERS_STREAM, ["order_date"]),
    "orders_batch_errors": (ERRORS, []),
    "orders_stream_errors": (ERRORS, []),
    **{name: (schema, []) for name, schema in REFERENCE_TABLES.items()},
}

# The keys of the raw tables: their NOT NULL columns.
SNAPSHOT_KEYS = {name: [f.name for f in schema.fields if not f.nullable] for name, (schema, _) in RAW_TABLES.items()}
