"""From order files and messages through raw tables to the stored star schema."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.__main__ import main
from ordermill.plans.build_job import LAYER, REPORTS, Built, build
from ordermill.plans.model import Models, StoredRaw
from ordermill.schemas import ORDER_COLUMNS, ORDERS_STREAM, RAW_TABLES
from ordermill.sources import files
from ordermill.sources.messages import read_message_stream
from ordermill.sources.snapshots import SnapshotTable
from ordermill.streaming.orders_stream import RunCounters, start
from ordermill.streaming.reconcile import reconcile_sink
from tests.helpers import GOOD


def _csv(path, columns, rows):
    with open(path, "w") as f:
        f.write("\n".join([",".join(columns)] + [",".join(r) for r in rows]) + "\n")
    return path


def _orders(path, *rows):
    return _csv(path, ORDER_COLUMNS, [[dict(GOOD, **r)[c] for c in ORDER_COLUMNS] for r in rows])


def _messages(spark, path, *rows):
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    lines = [r if isinstance(r, str) else json.dumps(dict(GOOD, source_system="stream", event_timestamp=stamp, **r))
             for r in rows]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(path)


def _run(capsys, *argv):
    assert main(list(argv)) == 0
    return (capsys.readouterr().out.strip().splitlines() or [""])[-1]


def test_files_and_messages_to_reports_twice(spark, tmp, capsys):
    raw, models = f"{tmp}/raw", f"{tmp}/models"
    assert sorted(json.loads(_run(capsys, "create", "--raw", raw))["created"]) == sorted(RAW_TABLES)
    refs = [("products", ["product_id", "category", "subcategory", "brand", "season_tag", "mrp",
                          "profit_margin_pct", "supplier_name", "stock_level"],
             [["238", " Shoes ", "Run", "B", "S", "10.0", "1.5", "X", "3"], ["9", "Bags", "T", "B", "S", "1", "1", "X", "3"]]),
            ("customers", ["customer_id", "customer_name", "age_group", "gender", "city", "state", "membership_type",
                           "customer_segment", "annual_income_group", "signup_date"],
             [["632", "Asha", "a", "f", "Pune", "MH", "Gold", "s", "i", "2020-01-02"]]),
            ("campaigns", ["campaign_id", "campaign_name", "expected_performance"], [["4", "Four", "High"]])]
    refs = [f"{n}={_csv(f'{tmp}/{n}.csv', cols, rows)}" for n, cols, rows in refs]
    orders = _orders(f"{tmp}/o1.csv", {"order_id": "A1"}, {"order_id": "A2", "campaign_id": "4.0"},
                     {"order_id": "A3", "quantity": "0"})
    out = json.loads(_run(capsys, "batch", "--orders", orders, "--raw", raw, *sum((["--reference", r] for r in refs), [])))
    assert out["orders"] == {"total_rows": 3, "good_rows": 2, "bad_rows": 1} and out["products"]["table_rows"] == 2
    _messages(spark, f"{tmp}/in", {"order_id": "S1", "product_id": "9"}, {"order_id": "A1", "quantity": "5"}, "no json")
    stream = ["stream", "--source", f"{tmp}/in", "--good", f"{raw}/orders_stream", "--bad", f"{raw}/orders_stream_errors",
              "--checkpoint", f"{tmp}/ck", "--once", "--sinks-must-exist"]
    seen = json.loads(_run(capsys, *stream))
    assert (seen["total_rows"], seen["good_rows"], seen["bad_rows"], seen["dropped_by_watermark"]) == (3, 2, 1, 0)
    assert json.loads(_run(capsys, "counts", "--raw", raw)) == {
        "orders_batch": 2, "orders_stream": 2, "orders_batch_errors": 1, "orders_stream_errors": 1,
        "customers": 1, "products": 2, "campaigns": 1}

    first = json.loads(_run(capsys, "build", "--raw", raw, "--models", models))
    assert first["run"] == "full" and first["fact_orders"] == 3 and first["dim_date"] == 4001
    fact = lambda: {r["order_id"]: (r["source_system"], r["quantity"])
                    for r in Built(spark, models).tables["fact_orders"].collect()}
    assert fact() == {"A1": ("stream", 5), "A2": ("batch", 1), "S1": ("stream", 1)}
    again = json.loads(_run(capsys, "build", "--raw", raw, "--models", models))
    assert again == first | {"run": "incremental"}

    # a new order, and a newer copy of a stored one that moves to another day
    _run(capsys, "batch", "--raw", raw, "--orders",
         _orders(f"{tmp}/o2.csv", {"order_id": "A4"}, {"order_id": "A2", "order_date": "2026-06-01"}))
    third = json.loads(_run(capsys, "build", "--raw", raw, "--models", models))
    assert (third["run"], third["fact_orders"]) == ("incremental", 4)
    stored, lazy = Built(spark, models), Models(StoredRaw(spark, raw))
    cols = sorted(lazy.fact_orders.columns)
    rows = lambda df: sorted(map(str, df.select(cols).collect()))
    assert rows(stored.tables["fact_orders"]) == rows(lazy.fact_orders)  # incremental = rebuilt
    for name, (fn, dims) in REPORTS.items():
        kw = {"as_of": dt.date(2026, 6, 2)} if name == "revenue_by_category_90d" else {}
        want = fn(lazy.fact_orders, *[getattr(lazy, d) for d in dims], **kw).collect()
        assert sorted(map(str, stored.report(name, **kw).collect())) == sorted(map(str, want)) and want, name
    checks = json.loads(_run(capsys, "quality", "--models", models))
    assert len(checks) == 16 and set(checks.values()) == {0}
    assert spark.table("rpt_sales_summary").count() == 2
    _run(capsys, "report", "source_volume", "--models", models, "--out", f"{tmp}/report")
    assert spark.read.parquet(f"{tmp}/report").count() == 2
    _run(capsys, "governed", "--models", models, "--principal", "ana", "--allow", "ana=order_date >= DATE'2026-06-01'",
         "--mask", "revenue=fin", "--out", f"{tmp}/view")
    view = spark.read.parquet(f"{tmp}/view").collect()
    assert [(r["order_id"], r["revenue"]) for r in view] == [("A2", None)]


def test_stored_fact_prunes_partitions(spark, tmp):
    fact = Models(_stand_in(spark)).fact_orders
    files.write_table(fact, f"{tmp}/reporting/fact_orders", ["order_date"])
    for name in ("dim_product",):
        files.write_table(getattr(Models(_stand_in(spark)), name), f"{tmp}/reporting/{name}")
    stored = spark.read.parquet(f"{tmp}/reporting/fact_orders")
    fn, _ = REPORTS["revenue_by_category_90d"]
    plan = fn(stored, spark.read.parquet(f"{tmp}/reporting/dim_product"), as_of=dt.date(2001, 8, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in text and "WindowGroupLimit" not in text
    policy = stored.where("warehouse_region = 'AMERICA'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(warehouse_region,AMERICA)" in policy


def _stand_in(spark):
    from ordermill.plans.model import StandInRaw
    from ordermill.sources.testdata import Tables
    return StandInRaw(Tables(spark, "/root/testdata/sf0.001"))


def test_upsert_after_an_empty_load_and_with_repeated_keys(spark, tmp):
    schema = "k string, p date, v int"
    empty = spark.createDataFrame([], schema)
    files.upsert_table(spark, empty, f"{tmp}/t", ["k"], "p")
    files.upsert_table(spark, empty, f"{tmp}/t", ["k"], "p")
    day = dt.date(2026, 1, 1)
    files.upsert_table(spark, spark.createDataFrame([("a", None, 1), ("b", day, 1)], schema), f"{tmp}/t", ["k"], "p")
    with pytest.raises(ValueError, match="more than once"):
        files.upsert_table(spark, spark.createDataFrame([("c", day, 1), ("c", day, 2)], schema), f"{tmp}/t", ["k"], "p")
    files.upsert_table(spark, spark.createDataFrame([("a", day, 2)], schema), f"{tmp}/t", ["k"], "p")
    got = sorted((r["k"], r["p"], r["v"]) for r in spark.read.parquet(f"{tmp}/t").collect())
    assert got == [("a", day, 2), ("b", day, 1)] and not os.path.exists(f"{tmp}/_pending_t")


def test_a_lost_replacement_is_finished_by_the_next_write(spark, tmp, monkeypatch):
    schema = "k string, p string, v int"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    files.upsert_table(spark, make(("a", "x", 1), ("b", "x", 1), ("c", "y", 1)), f"{tmp}/t", ["k"], "p")

    def lost(*a, **kw):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(files, "write_table", lost)
        with pytest.raises(RuntimeError):
            files.upsert_table(spark, make(("a", "y", 2), ("b", "y", 2)), f"{tmp}/t", ["k"], "p")
    files.upsert_table(spark, make(("d", "y", 3)), f"{tmp}/t", ["k"], "p")
    got = sorted((r["k"], r["p"], r["v"]) for r in spark.read.parquet(f"{tmp}/t").collect())
    assert got == [("a", "y", 2), ("b", "y", 2), ("c", "y", 1), ("d", "y", 3)]
    assert not os.path.exists(f"{tmp}/t/p=x")


def test_not_null_columns_are_enforced(spark, tmp):
    rows = spark.createDataFrame([(None,)], "order_id string")
    rows = rows.select("order_id", *[F.lit(None).cast(f.dataType).alias(f.name)
                                     for f in ORDERS_STREAM.fields if f.name != "order_id"])
    with pytest.raises(Exception, match="null in NOT NULL column order_id"):
        files.write_table(files.enforce_not_null(rows, ORDERS_STREAM), f"{tmp}/t")


def test_only_bad_messages_then_restart_and_counters(spark, tmp):
    def run():
        counters = RunCounters()
        spark.streams.addListener(counters)
        query = start(read_message_stream(spark, f"{tmp}/in"), f"{tmp}/good", f"{tmp}/bad", f"{tmp}/ck",
                      trigger={"availableNow": True})
        query.awaitTermination()
        spark.streams.removeListener(counters)
        return counters.counts
    _messages(spark, f"{tmp}/in", "bad", "bad")
    counts = run()
    assert (counts["total_rows"], counts["bad_rows"], counts["dropped_as_copies"]) == (2, 2, 1)
    _messages(spark, f"{tmp}/in", {"order_id": "A"})
    assert run()["good_rows"] == 1
    assert [r["order_id"] for r in files.read_declared(spark, f"{tmp}/good", ORDERS_STREAM).collect()] == ["A"]


def test_reconciliation_rewrites_touched_partitions_only(spark, tmp):
    schema = "order_id string, ingestion_timestamp timestamp, batch_id string, order_date date"
    at = lambda m: dt.datetime(2026, 5, 30, 10, m)
    d1, d2 = dt.date(2026, 5, 1), dt.date(2026, 5, 2)
    rows = [("A", at(0), "r-0", d1), ("B", at(0), "r-0", d1), ("A", at(5), "r-1", d1), ("C", at(5), "r-1", d2)]
    spark.createDataFrame(rows, schema).write.partitionBy("batch_id", "order_date").parquet(f"{tmp}/t")
    before = set(os.listdir(f"{tmp}/t/batch_id=r-0/order_date=2026-05-01"))
    assert reconcile_sink(spark, f"{tmp}/t") == {"duplicate_keys_before": 1, "duplicate_keys_after": 0}
    assert set(os.listdir(f"{tmp}/t/batch_id=r-0/order_date=2026-05-01")) == before
    assert not os.path.exists(f"{tmp}/t/batch_id=r-1/order_date=2026-05-01")
    got = sorted((r["order_id"], r["batch_id"]) for r in spark.read.parquet(f"{tmp}/t").collect())
    assert got == [("A", "r-0"), ("B", "r-0"), ("C", "r-1")]


def test_uniqueness_of_a_load_by_its_new_keys(spark, tmp):
    path = f"{tmp}/models/{LAYER}/fact_orders"
    rows = lambda *ids: spark.createDataFrame([(i, "2024-01-0" + str(1 + n)) for n, i in enumerate(ids)], "order_id string, day string")
    table = SnapshotTable(spark, path)
    table.create(rows("a").schema, ["order_id"], ["day"])
    first = table.append(rows("a", "b", "a"))
    second = table.append(rows("b", "c"))
    built = Built(spark, f"{tmp}/models")
    found = lambda since: sorted(map(tuple, built.repeated_orders(since).collect()))
    assert found(0) == [("a", 2), ("b", 2)]
    assert found(first) == [("b", 2)] and found(second) == []
