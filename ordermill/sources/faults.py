"""Stand-ins with planted faults, derived from the given tables by rules on
their keys: text rows that fail each check, wide discounts and keys, a star
schema that breaks each declared check.  Queries over them can fail where
the clean stand-ins cannot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.sources import testdata as td


def _pick(key: Column, cases: list[tuple[int, int, Column]], otherwise: Column) -> Column:
    """The value of the first (modulus, rest, value) the key matches."""
    out = F.when(F.lit(False), otherwise)
    for modulus, rest, value in cases:
        out = out.when(key % modulus == rest, value)
    return out.otherwise(otherwise)


def order_text_rows(t: td.Tables) -> DataFrame:
    """Order rows as text with missing fields, bad numbers and dates, odd but
    good numbers, and over-long text."""
    eid = F.col("_pos")
    s = F.lit
    faults = {
        "order_id": [(13, 1, s(""))],
        "customer_id": [(13, 1, s("")), (17, 2, s(None).cast("string"))],
        "order_date": [(19, 3, s("2024-02-30")), (23, 4, s("30/05/2024"))],
        "unit_price": [(29, 5, s("12,5")), (31, 6, s("1_000.5e0"))],
        "campaign_id": [(37, 7, s("x"))],
        "customer_rating": [(41, 8, s("4.5"))],
        "customer_city": [(43, 9, F.repeat(s("long "), 500))],
        "quantity": [(43, 9, s("-1")), (47, 10, s(" +1_0 ")), (53, 11, s("1__0"))],
    }
    rows = td.order_text_rows(t)
    return rows.withColumns({c: _pick(eid, cases, F.col(c)) for c, cases in faults.items()})


def many_order_messages(t: td.Tables) -> tuple[DataFrame, DataFrame]:
    """(text rows, their messages) with an order id per few events, so that
    landed, rejected and unseen ids all occur."""
    rows = td.order_text_rows(t)
    rows = rows.withColumn("order_id", F.concat("order_id", F.lit("-"), (F.col("_pos") % 500).cast("string")))
    return rows, td.messages_of(rows)


def wide_discounts(orders: DataFrame) -> DataFrame:
    """Orders whose discounts have six decimals or pass 1000 percent."""
    extra = _pick(F.col("product_id"), [(50, 7, F.lit(0.123456)), (97, 11, F.lit(1000.5))], F.lit(0.0))
    return orders.withColumn("discount", F.col("discount") + extra)


def odd_prices(orders: DataFrame) -> DataFrame:
    """Orders with prices that validation accepts and sums must survive: huge of
    either sign, NaN and infinite, per region, so that groups of each kind and clean groups occur."""
    region, p, c = F.col("warehouse_region"), F.col("product_id"), F.col("customer_id")

    def price(text):
        return F.lit(text).cast("double")
    odd = (F.when((region == "AMERICA") & (p % 20 == 3), price("1e18"))
           .when((region == "AMERICA") & (p % 20 == 4), price("-1e18"))
           .when((region == "AFRICA") & (p % 100 == 5), price("1e13"))
           .when((region == "ASIA") & (p % 50 == 7), price("NaN"))
           .when(region.isin("EUROPE", "ASIA") & (p % 50 == 9), price("Infinity"))
           .when((region == "MIDDLE EAST") & (p % 50 == 11), price("-Infinity"))
           .when((region == "MIDDLE EAST") & (c % 2 == 0) & (p % 50 == 12), price("Infinity")))
    return orders.withColumn("unit_price", F.when(odd.isNotNull(), odd).otherwise(F.col("unit_price")))


def wide_product_text_rows(t: td.Tables) -> DataFrame:
    """Product text rows, every eleventh with a key above 2^53, some with a
    key written as a float."""
    key = F.col("product_id").try_cast("bigint")
    wide = _pick(key, [(11, 4, (key + F.lit(2 ** 53)).cast("string")), (13, 5, F.concat("product_id", F.lit(".0")))],
                 F.col("product_id"))
    return td.product_text_rows(t).withColumn("product_id", wide)


def _twice(df: DataFrame, where: Column) -> DataFrame:
    times = F.when(where, F.lit(2)).otherwise(F.lit(1))
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), times))).drop("_i")


def broken_star(model) -> dict[str, DataFrame]:
    """The star schema with nulls, orphans and repeated keys."""
    c, p = F.col("customer_key"), F.col("product_key")
    null = lambda x: F.lit(None).cast(x)
    fact = model.fact_orders.select("order_id", "customer_key", "product_key", "campaign_key", "revenue")
    fact = _twice(fact, p % 127 == 7).select(
        F.when(p % 101 != 0, F.col("order_id")).alias("order_id"),
        _pick(p, [(103, 1, null("bigint")), (103, 2, c + 1_000_000_000_000)], c).alias("customer_key"),
        _pick(c, [(107, 3, null("bigint")), (107, 4, -p)], p).alias("product_key"),
        _pick(p, [(109, 5, F.lit(99).cast("bigint"))], F.col("campaign_key")).alias("campaign_key"),
        F.when(c % 113 != 6, F.col("revenue")).alias("revenue"))

    def dim(name, key, null_at, twice_at):
        df = _twice(getattr(model, name).select(key), twice_at)
        return df.select(F.when(~null_at, F.col(key)).alias(key))
    k, d = F.col("campaign_key"), F.col("date_key")
    return {"fact_orders": fact,
            "dim_customer": dim("dim_customer", "customer_key", c % 131 == 1, c % 137 == 2),
            "dim_product": dim("dim_product", "product_key", p % 131 == 1, p % 137 == 2),
            "dim_campaign": dim("dim_campaign", "campaign_key", k == 5, k == 3),
            "dim_date": dim("dim_date", "date_key", F.day(d) == 31, F.day(d) == 29)}
