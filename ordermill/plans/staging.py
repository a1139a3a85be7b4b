"""Staging models: projections with whitespace trimmed and columns renamed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.text import trim_ws

ORDER_TRIMMED = ["payment_method", "order_status", "warehouse_region",
                 "customer_city", "customer_state"]
STG_ORDER_COLUMNS = [
    "order_id", "customer_id", "product_id", "region_id", "campaign_id", "order_date",
    "quantity", "unit_price", "discount", "shipping_cost", "payment_method", "delivery_days",
    "returned_flag", "order_status", "warehouse_region", "customer_rating", "customer_city",
    "customer_state", "source_system", "loaded_at"]


def stg_orders(raw: DataFrame, source: str) -> DataFrame:
    """stg_orders_batch / stg_orders_stream: 20 columns, 5 text columns
    trimmed, the source tagged, ingestion time as loaded_at (event_timestamp
    of the stream is dropped)."""
    cols = []
    for c in STG_ORDER_COLUMNS:
        if c == "source_system":
            cols.append(F.lit(source).alias(c))
        elif c == "loaded_at":
            cols.append(F.col("ingestion_timestamp").alias(c))
        elif c in ORDER_TRIMMED:
            cols.append(trim_ws(c).alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def stg_orders_batch(raw_orders_batch: DataFrame) -> DataFrame:
    return stg_orders(raw_orders_batch, "batch")


def stg_orders_stream(raw_orders_stream: DataFrame) -> DataFrame:
    return stg_orders(raw_orders_stream, "stream")


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select("customer_id", trim_ws("customer_name").alias("customer_name"),
                      "age_group", "gender", trim_ws("city").alias("city"),
                      trim_ws("state").alias("state"), "membership_type", "customer_segment",
                      "annual_income_group", "signup_date")


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select("product_id", trim_ws("category").alias("category"),
                      trim_ws("subcategory").alias("subcategory"), trim_ws("brand").alias("brand"),
                      "season_tag", F.col("mrp").alias("list_price"), "profit_margin_pct",
                      trim_ws("supplier_name").alias("supplier_name"), "stock_level")


def stg_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select("campaign_id", trim_ws("campaign_name").alias("campaign_name"),
                      "expected_performance")
