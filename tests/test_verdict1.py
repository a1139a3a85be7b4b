"""Cases found by review: money, keys, files, messages, stream sinks."""

import json

import pytest
from pyspark.sql import functions as F

from ordermill.functions import money
from ordermill.operators.validate import coerce_dimension
from ordermill.schemas import ORDER_COLUMNS
from ordermill.sources.files import read_csv_strings, upsert_table
from ordermill.sources.messages import decode_orders
from ordermill.sources.testdata import Tables
from ordermill.streaming.orders_stream import start
from ordermill.streaming.reconcile import reconcile_sink
from tests.helpers import GOOD


def test_revenue_keeps_every_digit_and_never_fails(spark):
    rows = [(1000, 999.99, 12.345678), (1, 5.0, 1000.0), (1, float("nan"), 0.0), (1, float("inf"), 0.0), (2, 0.125, 0.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "quantity long, unit_price double, discount double")
           .select(money.revenue()).collect()]
    assert got[0] == 876534.45 and got[1] == -45.0 and got[2] != got[2] and got[3] == float("inf") and got[4] == 0.25


def test_average_is_rounded_once(spark):
    df = spark.createDataFrame([(0.006,), (0.001,)], "x double")
    assert df.agg(money.avg_round("x", 2)).first()[0] == 0.0


def test_long_keys_stay_apart(spark):
    df = spark.createDataFrame([("9007199254740993",), ("9007199254740992",), ("3.0",), ("x",)], "id string")
    got = sorted(r[0] for r in coerce_dimension(df, {"int_cols": ["id"], "key": ["id"]}).collect())
    assert got == [3, 9007199254740992, 9007199254740993]


def test_csv_by_header_with_quotes(spark, tmp):
    with open(f"{tmp}/c.csv", "w") as f:
        f.write('name,id,note\n"A ""B"", C",1,"two\nlines"\nback\\,2,x\n')
    rows = read_csv_strings(spark, f"{tmp}/c.csv", ["id", "name"]).orderBy("_pos").collect()
    assert [(r["id"], r["name"]) for r in rows] == [("1", 'A "B", C'), ("2", "back\\")]
    with pytest.raises(ValueError):
        read_csv_strings(spark, f"{tmp}/c.csv", ["id", "other"])


def test_upsert_keeps_the_null_partition(spark, tmp):
    schema = "k string, p string, v int"
    upsert_table(spark, spark.createDataFrame([("a", None, 1), ("b", None, 1), ("c", "x", 1)], schema), f"{tmp}/t", ["k"], "p")
    upsert_table(spark, spark.createDataFrame([("d", None, 2), ("c", None, 2)], schema), f"{tmp}/t", ["k"], "p")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp}/t").collect()) == [("a", 1), ("b", 1), ("c", 2), ("d", 2)]


def test_only_whole_json_objects_pass(spark):
    texts = ['{"order_id":"A"}', "{'order_id':'A'}", '{"order_id":"A"} trailing', '{"order_id":"A"}{"order_id":"B"}',
             '{"order_id":"A"},{"order_id":"B"}', "[1]", "bad", ' {"order_id":"A"} ']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r["_not_object"] for r in decode_orders(df).collect()] == [False, True, True, True, True, True, True, False]


def test_appended_rows_are_seen(spark, tmp):
    spark.range(5).write.parquet(f"{tmp}/events.parquet")
    assert Tables(spark, tmp)["events"].count() == 5
    spark.range(5).write.mode("append").parquet(f"{tmp}/events.parquet")
    assert Tables(spark, tmp)["events"].count() == 10


def _land(spark, tmp, name, order_id, checkpoint):
    message = dict(GOOD, campaign_id="1", source_system="stream", order_id=order_id,
                   event_timestamp="2026-05-30T10:00:00.000Z")
    message = {k: v for k, v in message.items() if k in {*ORDER_COLUMNS, "source_system", "event_timestamp"}}
    spark.createDataFrame([(json.dumps(message),)], "value string").write.text(f"{tmp}/{name}")
    stream = spark.readStream.format("text").load(f"{tmp}/{name}").withColumn(
        "arrival_ts", F.lit("2026-05-30 10:00:10").cast("timestamp"))
    query = start(stream, f"{tmp}/good", f"{tmp}/bad", f"{tmp}/{checkpoint}", trigger={"availableNow": True})
    query.awaitTermination()


def test_new_checkpoint_and_reconciliation_keep_the_sink(spark, tmp):
    _land(spark, tmp, "in1", "A", "ck1")
    _land(spark, tmp, "in2", "A", "ck2")
    _land(spark, tmp, "in3", "B", "ck3")
    ids = lambda: sorted(r["order_id"] for r in spark.read.parquet(f"{tmp}/good").select("order_id").collect())
    assert ids() == ["A", "A", "B"]
    assert reconcile_sink(spark, f"{tmp}/good") == {"duplicate_keys_before": 1, "duplicate_keys_after": 0}
    _land(spark, tmp, "in4", "C", "ck4")
    assert ids() == ["A", "B", "C"]
