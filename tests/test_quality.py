from ordermill.operators.quality import run_suite


def test_suite_counts_planted_failures(spark):
    fact = spark.createDataFrame(
        [("o1", 1, 10, None, 5.0), ("o1", 2, 99, 3, None), ("o3", None, 10, 7, 1.0), (None, 1, 10, 1, 1.0)],
        "order_id string, customer_key long, product_key long, campaign_key long, revenue double")
    dim_c = spark.createDataFrame([(1,), (2,), (2,)], "customer_key long")
    dim_p = spark.createDataFrame([(10,)], "product_key long")
    dim_k = spark.createDataFrame([(1,), (3,), (None,)], "campaign_key long")
    dim_d = spark.createDataFrame([("2026-01-01",)], "date_key string")
    out = run_suite({"fact_orders": fact, "dim_customer": dim_c, "dim_product": dim_p,
                     "dim_campaign": dim_k, "dim_date": dim_d})
    got = {(r.table_name, r.column_name, r.test): r.failures for r in out.collect()}
    assert len(got) == 16
    assert got[("fact_orders", "order_id", "not_null")] == 1
    assert got[("fact_orders", "order_id", "unique")] == 1
    assert got[("fact_orders", "customer_key", "not_null")] == 1
    assert got[("fact_orders", "customer_key", "relationships")] == 0   # null key ignored
    assert got[("fact_orders", "product_key", "relationships")] == 1    # 99 has no parent
    assert got[("fact_orders", "campaign_key", "relationships")] == 1   # 7 has no parent
    assert got[("fact_orders", "revenue", "not_null")] == 1
    assert got[("dim_customer", "customer_key", "unique")] == 1
    assert got[("dim_campaign", "campaign_key", "not_null")] == 1
