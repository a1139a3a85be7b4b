"""Stand-ins: the driver's TPC-H-style tables shaped into the raw order layer.

Every function is lazy and derives its rows from the given tables, so the work
grows with them.  Timestamps in the test tables are TIMESTAMP_NTZ; they are
read as session-zone (UTC) timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ordermill.functions.parse import EVENT_TS_WRITE_FORMAT
from ordermill.session import prepare

TABLE_NAMES = ("region nation customer supplier part orders lineitem events "
               "documents embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy name -> DataFrame lookup over one folder of parquet tables.
    Each lookup object lists the files anew, so rows added between two
    queries are seen."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
            if ntz:
                df = df.withColumns({c: F.col(c).cast("timestamp") for c in ntz})
            self._cache[name] = df
        return self._cache[name]


def _customer_geo(t: Tables) -> DataFrame:
    # nation (25 rows) and region (5 rows) are fixed-size: broadcast is bounded.
    nation = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = t["region"].select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cust = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return cust.join(F.broadcast(geo.select("n_nationkey", "n_name", "r_name")),
                     cust.c_nationkey == F.col("n_nationkey"))


def _micros(ts_col: str):
    return F.unix_micros(F.col(ts_col))


def raw_orders(t: Tables, linestatus: str | None = None) -> DataFrame:
    """One typed raw order per line item (lineitem x orders x customer x geo).

    Orders are joined to customers first so that the big lineitem side is
    shuffled once (by order key), the smaller orders side twice.
    """
    li = t["lineitem"]
    if linestatus is not None:
        li = li.where(F.col("l_linestatus") == linestatus)
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                   "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                   "l_linestatus", "l_shipdate")
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                "o_orderpriority")
    geo = _customer_geo(t).select("c_custkey", "c_nationkey", "n_name", "r_name")
    oc = orders.join(geo, orders.o_custkey == geo.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    ship_us = _micros("l_shipdate")
    return j.select(
        F.concat(F.lit("ORD"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        F.col("c_nationkey").cast("bigint").alias("region_id"),
        F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey") % 10).cast("bigint")
         .alias("campaign_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.round(F.col("l_discount") * 100).alias("discount"),
        F.round(F.col("l_tax") * 100, 2).alias("shipping_cost"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("payment_method"),
        (F.col("l_linenumber") % 7 + 1).cast("bigint").alias("delivery_days"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("returned_flag"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("r_name").alias("warehouse_region"),
        (F.col("l_linenumber") % 5 + 1).cast("bigint").alias("customer_rating"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
        F.when(F.col("l_linestatus") == "F", "batch").otherwise("stream").alias("source_system"),
        F.timestamp_micros(ship_us + F.col("l_suppkey") * 1_000_000).alias("event_timestamp"),
        F.timestamp_micros(ship_us + F.col("l_suppkey") * 1_000_000 + F.col("l_partkey"))
         .alias("ingestion_timestamp"),
    )


def raw_orders_batch(t: Tables) -> DataFrame:
    return raw_orders(t, "F").drop("event_timestamp")


def raw_orders_stream(t: Tables) -> DataFrame:
    return raw_orders(t, "O")


def raw_customers(t: Tables) -> DataFrame:
    c = _customer_geo(t)
    null_s = F.lit(None).cast("string")
    return c.select(
        F.col("c_custkey").cast("bigint").alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("customer_name"),
        null_s.alias("age_group"), null_s.alias("gender"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("membership_type"),
        null_s.alias("customer_segment"), null_s.alias("annual_income_group"),
        F.lit(None).cast("date").alias("signup_date"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
    )


def raw_products(t: Tables) -> DataFrame:
    null_s = F.lit(None).cast("string")
    return t["part"].select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("subcategory"),
        F.col("p_brand").alias("brand"),
        null_s.alias("season_tag"),
        F.col("p_retailprice").alias("mrp"),
        F.lit(None).cast("double").alias("profit_margin_pct"),
        null_s.alias("supplier_name"),
        F.lit(None).cast("bigint").alias("stock_level"),
        F.lit(None).cast("timestamp").alias("ingestion_timestamp"),
    )


# Stand-in campaigns (id, name, expected performance).
CAMPAIGN_LIST = [(i, f"Campaign {i}", ("Low", "Medium", "High")[i % 3]) for i in range(1, 10)]


def raw_campaigns(t: Tables) -> DataFrame:
    """Campaigns that supplier keys map to (key % 10, 0 = organic), named from
    the fixed list.  Reads supplier, so the set follows the data."""
    ids = (t["supplier"].select((F.col("s_suppkey") % 10).cast("bigint").alias("campaign_id"))
           .where("campaign_id <> 0").distinct())
    names = t.spark.createDataFrame(CAMPAIGN_LIST,
                                    "campaign_id bigint, campaign_name string, expected_performance string")
    # at most 9 ids on either side: a bounded broadcast
    return ids.join(F.broadcast(names), "campaign_id", "left").select(
        "campaign_id", F.concat(F.lit(" "), F.col("campaign_name")).alias("campaign_name"),
        "expected_performance", F.lit(None).cast("timestamp").alias("ingestion_timestamp"))


# Warehouse hubs used by the event stand-in rows.
HUBS = ["North Hub", "South Hub", "East Hub", "West Hub"]


def order_text_rows(t: Tables) -> DataFrame:
    """Order rows as text (the CSV shape), one per event.

    Malformed on purpose: quantity 'N/A' when event_id % 97 = 0, '0' when
    event_id % 101 = 0 (the first rule wins).  campaign_id is '' (null) for
    every tenth id and otherwise float text like '3.0'.  The key
    user_id % 10 '-' event_type repeats, which the dedup operators need.
    """
    e = t["events"]
    eid, uid = F.col("event_id"), F.col("user_id")
    s = lambda c: c.cast("string")
    quantity = (F.when(eid % 97 == 0, F.lit("N/A"))
                .when(eid % 101 == 0, F.lit("0"))
                .otherwise(s(eid % 5 + 1)))
    return e.select(
        F.concat(s(uid % 10), F.lit("-"), F.col("event_type")).alias("order_id"),
        s(uid).alias("customer_id"),
        s(eid).alias("product_id"),
        s(uid % 25).alias("region_id"),
        F.when(eid % 10 != 0, F.concat(s(eid % 10), F.lit(".0"))).alias("campaign_id"),
        F.date_format("ts", "yyyy-M-d").alias("order_date"),
        quantity.alias("quantity"),
        F.concat(s(eid % 900 + 100), F.lit("."), F.lpad(s(uid % 100), 2, "0")).alias("unit_price"),
        s(eid % 11).alias("discount"),
        F.concat(s(uid % 50), F.lit(".5")).alias("shipping_cost"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")).alias("payment_method"),
        s(eid % 7 + 1).alias("delivery_days"),
        F.when(F.col("event_type") == "error", "1").otherwise("0").alias("returned_flag"),
        F.when(F.col("event_type") == "error", "Returned").otherwise("Delivered").alias("order_status"),
        F.element_at(F.array(*[F.lit(h) for h in HUBS]), (uid % 4 + 1).cast("int")).alias("warehouse_region"),
        s(eid % 5 + 1).alias("customer_rating"),
        F.concat(F.lit("City-"), s(uid % 30)).alias("customer_city"),
        F.concat(F.lit("State-"), s(uid % 8)).alias("customer_state"),
        # position in the source (the file order of a CSV read)
        eid.alias("_pos"),
        F.col("ts").alias("_event_ts"),
        F.timestamp_micros(_micros("ts") + ((eid * 37) % 600) * 1_000_000).alias("_arrival_ts"),
    )


def order_messages(t: Tables) -> DataFrame:
    """Order messages (JSON text) with the time each one arrived.

    event_timestamp is the event's ts in the message format; arrival is
    ts + (event_id * 37 % 600) seconds, so some events are too late.
    """
    return messages_of(order_text_rows(t))


def messages_of(rows: DataFrame) -> DataFrame:
    """Text rows of events as messages."""
    from ordermill.sources.messages import encode_orders
    rows = rows.withColumn("event_timestamp", F.date_format("_event_ts", EVENT_TS_WRITE_FORMAT))
    return encode_orders(rows, extra=["event_timestamp"]).select(
        "value", F.col("_arrival_ts").alias("arrival_ts"), "_pos")


def product_text_rows(t: Tables) -> DataFrame:
    """Product reference rows as text (the CSV shape) with faults to coerce:
    an empty key every 199th part, 'n/a' prices every 50th, 'many' stock
    levels every 31st."""
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    return t["part"].select(
        F.when(k % 199 == 7, F.lit("")).otherwise(s(k)).alias("product_id"),
        F.col("p_type").alias("category"),
        s(F.col("p_size")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.lit(None).cast("string").alias("season_tag"),
        F.when(k % 50 == 3, F.lit("n/a")).otherwise(s(F.col("p_retailprice"))).alias("mrp"),
        F.concat(s(F.col("p_size")), F.lit(".5")).alias("profit_margin_pct"),
        F.lit(None).cast("string").alias("supplier_name"),
        F.when(k % 31 == 0, F.lit("many")).otherwise(s(k % 500)).alias("stock_level"),
    )
