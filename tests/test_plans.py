"""Plan shapes that carry the scale properties."""

from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.operators.dedup import dedup, duplicate_copies
from ordermill.operators.joins import star_join
from tests.helpers import row, text_df


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_key_rows(spark, n=30_000):
    # one key holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").alias("ts"), F.lit("x").alias("v"))


def test_keep_one_per_key_limits_before_the_shuffle(spark):
    df = dedup(hot_key_rows(spark), ["order_id"], ["ts"], keep="last")
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    # the partial limit sits below the exchange
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")
    got = df.where("order_id = 'HOT'").collect()
    assert len(got) == 1 and got[0].ts == 29_997


def test_duplicate_copies_is_long_form(spark):
    df = hot_key_rows(spark).withColumnRenamed("ts", "ingestion_timestamp").withColumn(
        "event_timestamp", F.col("ingestion_timestamp"))
    out = duplicate_copies(df)
    assert "collect_list" not in plan(out)
    assert out.count() == 10_000 and out.select("copies").distinct().collect()[0][0] == 10_000


def test_star_join_broadcasts_only_on_measured_size(spark):
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    joined = star_join(fact, dim, "k")
    assert "BroadcastExchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.count() == 1000


def test_validation_split_does_not_reinline_parsing(spark):
    v = V.validate_orders(text_df(spark, [row(), row(order_id="B", quantity="0")]), "batch")
    bad = v.where(F.col("error_reason").isNotNull())
    p = plan(bad)
    assert "Generate" in p
    # the filter sits above the generator, not inlined into the scan
    assert p.index("Filter") < p.index("Generate")
    assert bad.count() == 1


def test_row_policy_reaches_the_scan(spark, tmp):
    path = f"{tmp}/fact"
    spark.createDataFrame([("o1", "AMERICA"), ("o2", "ASIA")], "order_id string, warehouse_region string") \
        .write.parquet(path)
    from ordermill.operators.governance import RowPolicy, governed
    pol = RowPolicy("am", frozenset({"u"}), "warehouse_region = 'AMERICA'")
    p = plan(governed(spark.read.parquet(path), "u", [pol]))
    pushed = p[p.index("PushedFilters"):]
    assert "EqualTo(warehouse_region,AMERICA)" in pushed[: pushed.index("ReadSchema")]


def test_incremental_mark_filters_before_the_dedup_shuffle(spark):
    import datetime as dt

    from ordermill.plans import marts

    def stg(src):
        return spark.range(2000).select(
            (F.col("id") % 500).cast("string").alias("order_id"),
            F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("loaded_at"),
            F.lit(src).alias("source_system"), F.lit(1).cast("bigint").alias("customer_id"),
            F.lit(1).cast("bigint").alias("product_id"), F.lit(1).cast("bigint").alias("region_id"),
            F.lit(None).cast("bigint").alias("campaign_id"), F.lit(dt.date(2026, 1, 1)).alias("order_date"),
            F.lit(1).cast("bigint").alias("quantity"), F.lit(1.0).alias("unit_price"),
            F.lit(0.0).alias("discount"), F.lit(0.0).alias("shipping_cost"), F.lit("x").alias("payment_method"),
            F.lit(1).cast("bigint").alias("delivery_days"), F.lit(0).cast("bigint").alias("returned_flag"),
            F.lit("x").alias("order_status"), F.lit("x").alias("warehouse_region"),
            F.lit(1).cast("bigint").alias("customer_rating"), F.lit("x").alias("customer_city"),
            F.lit("x").alias("customer_state"))

    b, s = stg("batch"), stg("stream")
    first = marts.fact_orders(marts.int_orders_unioned(b.where("loaded_at < timestamp_seconds(1700001000)"),
                                                       s.where("loaded_at < timestamp_seconds(1700001000)")))
    inc = marts.incremental_fact(b, s, first)
    lines = inc._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    # the mark (a scalar subquery) filters the sources below the dedup window
    marks = [i for i, ln in enumerate(lines) if "Filter" in ln and "scalar-subquery" in ln]
    assert marks
    m = marks[0]
    assert any("Window" in lines[i] and depth(lines[i]) < depth(lines[m]) for i in range(m))
    full = marts.fact_orders(marts.int_orders_unioned(b, s))
    assert sorted(inc.collect()) == sorted(full.collect())
