"""Reports over the star schema.  Money and discounts are summed exactly, whatever
their size (see functions.exact); sums, averages and ratios are rounded once.

Each report takes the fact and the dimensions it needs; ``as_of`` replaces
CURRENT_DATE so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.exact import avg_round, sum_round
from ordermill.functions.money import ratio_round
from ordermill.operators.exact_agg import exact_group
from ordermill.operators.joins import star_join

# Report constants.
ORGANIC = "No Campaign (Organic)"
RECENT_DAYS = 90
TOP_CUSTOMERS = 10


def total_revenue(col="revenue"):
    """round(sum, 2) of a measure that ``exact_group`` summed."""
    return sum_round(col, 2)


def whole_average(col: str, digits: int):
    """round(avg, digits) of a whole measure of ``exact_group``."""
    return ratio_round(F.col(f"{col}.s"), F.col(f"{col}.n"), digits)


def order_count():
    return F.count_distinct("order_id")


def _with_product(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return star_join(fact, dim_product.select("product_key", "category"), "product_key")


def revenue_by_category(fact: DataFrame, dim_product: DataFrame,
                        as_of: _dt.date | None = None, days: int | None = None) -> DataFrame:
    """Revenue by product category; with ``days``, only orders of the last
    ``days`` days before ``as_of`` (order_date >= as_of - days)."""
    if days is not None:
        as_of_col = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
        fact = fact.where(F.col("order_date") >= F.date_sub(as_of_col, days))
    return (exact_group(_with_product(fact, dim_product), ["category"], ("revenue",), "order_id")
            .select("category", F.col("ids").alias("order_count"), total_revenue().alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "category"))


def revenue_by_category_recent(fact, dim_product, as_of=None, days: int = RECENT_DAYS):
    return revenue_by_category(fact, dim_product, as_of, days)


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    """Top k (name, membership) groups by lifetime revenue.  Customers
    sharing a name and membership merge into one group.  Ties are broken by
    name, then membership, so the k rows are deterministic."""
    j = star_join(fact, dim_customer.select("customer_key", "customer_name", "membership_type"),
                  "customer_key")
    group = ["customer_name", "membership_type"]
    return (exact_group(j, group, ("revenue",), "order_id")
            .select(*group, F.col("ids").alias("order_count"), total_revenue().alias("lifetime_revenue"))
            .orderBy(F.desc("lifetime_revenue"), "customer_name", "membership_type")
            .limit(k))


def campaign_effectiveness(fact: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """Revenue attributed to each campaign vs organic orders (no campaign or
    a campaign key with no dimension row)."""
    j = star_join(fact, dim_campaign.select("campaign_key", "campaign_name"), "campaign_key", "left")
    j = j.withColumn("campaign_name", F.coalesce(F.col("campaign_name"), F.lit(ORGANIC)))
    return (exact_group(j, ["campaign_name"], ("revenue", "discount"), "order_id")
            .select("campaign_name", F.col("ids").alias("order_count"), total_revenue().alias("total_revenue"),
                    avg_round("discount", 2).alias("avg_discount_pct"))
            .orderBy(F.desc("total_revenue"), "campaign_name"))


def return_rate_by_region(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("warehouse_region")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("returned_flag").alias("returned_orders"),
                 ratio_round(F.sum("returned_flag"), F.count(F.lit(1)), 2, 100)
                 .alias("return_rate_pct"))
            .orderBy(F.desc("return_rate_pct"), "warehouse_region"))


def source_volume(fact: DataFrame) -> DataFrame:
    return exact_group(fact, ["source_system"], ("revenue",)).select(
        "source_system", F.col("rows").alias("order_count"), total_revenue().alias("total_revenue"))


def sales_summary(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """rpt_sales_summary: category x warehouse region (7 columns)."""
    group = ["category", "warehouse_region"]
    return exact_group(_with_product(fact, dim_product), group, ("revenue",), "order_id",
                       ("returned_flag", "delivery_days")).select(
        *group, F.col("ids").alias("total_orders"), total_revenue().alias("total_revenue"),
        avg_round("revenue", 2).alias("avg_order_value"),
        ratio_round(F.col("returned_flag.s"), F.col("rows"), 2, 100).alias("return_rate_pct"),
        whole_average("delivery_days", 1).alias("avg_delivery_days"))


def kpi_scorecard(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Dashboard scorecards over the sales-summary rows: computed from the
    fact rows themselves, so averages are weighted by orders (an average of
    the summary's averages would not be)."""
    return exact_group(_with_product(fact, dim_product), [], ("revenue",), "order_id", ("delivery_days",)).select(
        total_revenue().alias("total_revenue"), F.col("ids").alias("total_orders"),
        whole_average("delivery_days", 1).alias("avg_delivery_days"),
        avg_round("revenue", 2).alias("avg_order_value"))


def revenue_over_time(fact: DataFrame) -> DataFrame:
    return (exact_group(fact, ["order_date"], ("revenue",), "order_id")
            .select("order_date", F.col("ids").alias("order_count"), total_revenue().alias("total_revenue"))
            .orderBy("order_date"))


def orders_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (_with_product(fact, dim_product).groupBy("category")
            .agg(order_count().alias("total_orders")).orderBy(F.desc("total_orders"), "category"))
