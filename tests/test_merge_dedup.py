import datetime as dt
import os

from pyspark.sql import functions as F

from ordermill.operators.dedup import dedup, duplicate_copies, reconcile
from ordermill.operators.upsert import incremental_merge, insert_only, upsert
from ordermill.plans import marts
from ordermill.plans.batch_job import ingest_orders
from ordermill.schemas import ORDER_COLUMNS
from ordermill.sources.files import upsert_table


def T(s):
    return dt.datetime.fromisoformat(s)


def test_dedup_policies(spark):
    df = spark.createDataFrame([("a", 1, T("2026-01-01 00:00:02")), ("a", 2, T("2026-01-01 00:00:01")),
                                ("b", 3, T("2026-01-01 00:00:05"))], "k string, pos int, ts timestamp")
    last = {r.k: r.pos for r in dedup(df, ["k"], ["pos"], keep="last").collect()}
    first = {r.k: r.pos for r in dedup(df, ["k"], ["ts"], keep="first").collect()}
    assert last == {"a": 2, "b": 3} and first == {"a": 2, "b": 3}


def test_reconcile_keeps_exactly_one_on_equal_timestamps(spark):
    ts = T("2026-01-01 00:00:00")
    df = spark.createDataFrame([("o1", ts, "x"), ("o1", ts, "y"), ("o2", ts, "z")],
                               "order_id string, ingestion_timestamp timestamp, v string")
    out = reconcile(df).collect()
    assert sorted((r.order_id, r.v) for r in out) == [("o1", "x"), ("o2", "z")]
    copies = duplicate_copies(df.withColumn("event_timestamp", F.col("ingestion_timestamp"))).collect()
    assert [(r.order_id, r.copies) for r in copies] == [("o1", 2), ("o1", 2)]


def test_upsert_and_insert_only(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    src = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert sorted(upsert(tgt, src, ["k"]).collect()) == [("a", 1), ("b", 20), ("c", 30)]
    dup_src = spark.createDataFrame([("b", 99), ("d", 4), ("d", 4)], "k string, v int")
    assert sorted(insert_only(tgt, dup_src, ["k"]).collect()) == [("a", 1), ("b", 2), ("d", 4), ("d", 4)]


def test_incremental_high_water_mark(spark):
    src = spark.createDataFrame([("a", T("2026-01-02")), ("b", T("2026-01-03"))], "order_id string, loaded_at timestamp")
    assert incremental_merge(src, None, ["order_id"]).count() == 2           # first run: all
    empty = src.limit(0)
    assert incremental_merge(src, empty, ["order_id"]).count() == 0          # empty target: nothing
    tgt = spark.createDataFrame([("a", T("2026-01-02"))], "order_id string, loaded_at timestamp")
    got = incremental_merge(src, tgt, ["order_id"]).collect()
    assert sorted(r.order_id for r in got) == ["a", "b"]


def test_upsert_table_moves_partition(spark, tmp):
    path = os.path.join(tmp, "t")
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    first = spark.createDataFrame([("a", d1, 1), ("b", d1, 2)], "order_id string, order_date date, v int")
    upsert_table(spark, first, path, ["order_id"], partition_by="order_date")
    moved = spark.createDataFrame([("a", d2, 10)], "order_id string, order_date date, v int")
    upsert_table(spark, moved, path, ["order_id"], partition_by="order_date")
    got = sorted((r.order_id, r.order_date, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", d2, 10), ("b", d1, 2)]
    gone = spark.createDataFrame([("b", d2, 20)], "order_id string, order_date date, v int")
    upsert_table(spark, gone, path, ["order_id"], partition_by="order_date")
    assert not os.path.exists(os.path.join(path, "order_date=2026-01-01"))
    assert spark.read.parquet(path).count() == 2


def test_batch_ingest_is_idempotent(spark, tmp):
    csv = os.path.join(tmp, "orders.csv")
    lines = [",".join(ORDER_COLUMNS),
             "A1,1,2,3,,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH",
             "A1,1,2,3,,2026-05-31,2,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH",
             "A2,1,2,3,2.0,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,East Hub,4,Pune,MH",
             "B1,,2,3,,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH",
             "B2,1,2,3,,2026-05-30,0,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH"]
    with open(csv, "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = os.path.join(tmp, "raw")
    clock = F.lit(dt.datetime(2026, 6, 1)).cast("timestamp")
    counts = ingest_orders(spark, csv, raw, clock)
    assert counts == {"total_rows": 5, "good_rows": 3, "bad_rows": 2}
    good = spark.read.parquet(f"{raw}/orders_batch")
    a1 = good.where("order_id = 'A1'").collect()
    assert len(a1) == 1 and a1[0].quantity == 2 and a1[0].order_date == dt.date(2026, 5, 31)  # last row wins
    ingest_orders(spark, csv, raw, F.lit(dt.datetime(2026, 6, 2)).cast("timestamp"))
    assert spark.read.parquet(f"{raw}/orders_batch").count() == 2
    assert spark.read.parquet(f"{raw}/orders_batch_errors").count() == 2


def test_date_spine(spark):
    dd = marts.dim_date(marts.date_spine(spark))
    assert dd.count() == 4001
    last = dd.orderBy(F.desc("date_key")).first()
    assert last.date_key == dt.date(2025, 12, 14)
    first = dd.orderBy("date_key").first()
    assert (first.day_name, first.month_name, first.day_of_week, first.quarter) == ("Thursday", "January", 5, 1)


def test_reference_load_coerces_and_drops_missing_keys(spark, tmp):
    from ordermill.plans.batch_job import ingest_reference
    csv = os.path.join(tmp, "products.csv")
    with open(csv, "w") as f:
        f.write("product_id,category,subcategory,brand,season_tag,mrp,profit_margin_pct,supplier_name,stock_level\n")
        f.write("1,Shoes,Run,Acme,Summer,100.5,12.5,S1,10\n")
        f.write(",Shoes,Run,Acme,Summer,100.5,12.5,S1,10\n")
        f.write("2,Bags,Tote,Acme,Winter,n/a,x,S2,many\n")
    out = ingest_reference(spark, "products", csv, os.path.join(tmp, "raw"),
                           F.lit(dt.datetime(2026, 6, 1)).cast("timestamp"))
    assert out == {"rows": 3, "kept": 2, "dropped_missing_key": 1, "table_rows": 2}
    p2 = spark.read.parquet(os.path.join(tmp, "raw", "products")).where("product_id = 2").first()
    assert p2.mrp is None and p2.stock_level is None and p2.category == "Bags"


def test_reference_file_with_repeated_key_fails(spark, tmp):
    import pytest
    from ordermill.plans.batch_job import ingest_reference
    csv = os.path.join(tmp, "campaigns.csv")
    with open(csv, "w") as f:
        f.write("campaign_id,campaign_name,expected_performance\n1,A,High\n1,B,Low\n")
    with pytest.raises(ValueError, match="occurs more than once"):
        ingest_reference(spark, "campaigns", csv, os.path.join(tmp, "raw"))
