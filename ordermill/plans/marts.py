"""Intermediate and mart models: the unioned order layer, the star schema
(dimensions + fact) and the date dimension."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.dates import calendar_parts, display_date
from ordermill.functions.money import revenue
from ordermill.operators.dedup import dedup
from ordermill.operators.upsert import high_water_mark, incremental_merge, upsert


def int_orders_unioned(stg_batch: DataFrame, stg_stream: DataFrame) -> DataFrame:
    """Batch and stream orders in one layer, newest copy (loaded_at) per
    order_id.  Equal loaded_at: 'batch' before 'stream', then the other
    columns (ascending) decide, so the pick is deterministic."""
    unioned = stg_batch.unionByName(stg_stream)
    tie = ["source_system"]
    rest = [c for c in unioned.columns if c not in ("order_id", "loaded_at", "source_system")]
    return dedup(unioned, ["order_id"], ["loaded_at"], keep="last", tie_break=tie + rest)


def dim_customer(stg: DataFrame) -> DataFrame:
    return stg.select(F.col("customer_id").alias("customer_key"), "customer_name", "age_group",
                      "gender", "city", "state", "membership_type", "customer_segment",
                      "annual_income_group", "signup_date")


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(F.col("product_id").alias("product_key"), "category", "subcategory",
                      "brand", "season_tag", "list_price", "profit_margin_pct",
                      "supplier_name", "stock_level")


def dim_campaign(stg: DataFrame) -> DataFrame:
    return stg.select(F.col("campaign_id").alias("campaign_key"), "campaign_name",
                      "expected_performance")


def fact_rows(int_orders: DataFrame) -> DataFrame:
    """fact_orders projection: key renames, display date, exact revenue
    (quantity * unit_price * (1 - discount / 100), 2 decimals, no shipping)."""
    return int_orders.select(
        "order_id", F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"), F.col("campaign_id").alias("campaign_key"),
        "region_id", "order_date", display_date(F.col("order_date")).alias("order_date_formatted"),
        "quantity", "unit_price", "discount", "shipping_cost", revenue().alias("revenue"),
        "payment_method", "delivery_days", "returned_flag", "order_status", "warehouse_region",
        "customer_rating", "source_system", "loaded_at")


def fact_orders(int_orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Incremental fact: the first run (no existing table) takes every row;
    later runs merge rows newer than the table's max(loaded_at) by order_id."""
    return incremental_merge(fact_rows(int_orders), existing, ["order_id"], "loaded_at")


def incremental_fact(stg_batch: DataFrame, stg_stream: DataFrame,
                     existing: DataFrame | None) -> DataFrame:
    """The incremental fact run, with the high-water mark applied before the
    dedup instead of after it.

    With latest-wins on loaded_at, an order whose newest copy is newer than
    the mark has all its newest copies (ties included) above the mark, and
    an order with no copy above the mark is not in the new rows either way:
    filtering first gives the same rows, but only new rows are shuffled for
    the dedup, not the whole history."""
    if existing is None:
        return fact_orders(int_orders_unioned(stg_batch, stg_stream))
    new = new_fact_rows(stg_batch, stg_stream, high_water_mark(existing, "loaded_at"))
    return upsert(existing, new, ["order_id"])


def new_fact_rows(stg_batch: DataFrame, stg_stream: DataFrame, mark: Column) -> DataFrame:
    """Fact rows of the orders loaded after the mark."""
    new_b = stg_batch.where(F.col("loaded_at") > mark)
    new_s = stg_stream.where(F.col("loaded_at") > mark)
    return fact_rows(int_orders_unioned(new_b, new_s))


# The date dimension's default span (first day, number of days after it).
DATE_SPINE_START = _dt.date(2015, 1, 1)
DATE_SPINE_DAYS = 4000


def date_spine(spark: SparkSession, start=DATE_SPINE_START, days: int = DATE_SPINE_DAYS) -> DataFrame:
    """One row per day, start .. start + days inclusive, generated by
    spark.range in parallel (no driver-side list)."""
    start_col = F.lit(start).cast("date") if not hasattr(start, "_jc") else start
    return spark.range(0, days + 1).select(F.date_add(start_col, F.col("id").cast("int")).alias("full_date"))


def dim_date(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    parts = calendar_parts(d)
    return spine.select(d.alias("date_key"), *[v.alias(k) for k, v in parts.items()])


def date_spine_between(df: DataFrame, date_col: str) -> DataFrame:
    """Spine over the [min, max] of a date column of the data: one
    aggregate row, then sequence + explode (the span, not the data, sets
    the size)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
