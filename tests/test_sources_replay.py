import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.operators.dedup import dedup
from ordermill.plans.replay import error_order_ids, pending_rows, to_messages
from ordermill.schemas import ORDER_COLUMNS
from ordermill.sources.files import materialize, read_csv_strings
from ordermill.sources.messages import decode_orders
from tests.helpers import row, text_df


def test_csv_last_row_wins_in_file_order(spark, tmp):
    d = os.path.join(tmp, "csv")
    os.makedirs(d)
    head = ",".join(ORDER_COLUMNS)
    body = [f"K{i % 7},1,2,3,,2026-05-30,{i + 1},10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH"
            for i in range(200)]
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write(head + "\n" + "\n".join(body) + "\n")
    rows = read_csv_strings(spark, d, ORDER_COLUMNS)
    assert rows.where(F.col("customer_id").isNull()).count() == 0
    last = dedup(V.validate_orders(rows, "batch"), ["order_id"], ["_pos"], keep="last")
    got = {r.order_id: r.quantity for r in last.collect()}
    assert got == {f"K{k}": max(i + 1 for i in range(200) if i % 7 == k) for k in range(7)}


def test_replay_messages_round_trip(spark):
    rows = text_df(spark, [row(order_id="R1"), row(order_id="R2", campaign_id="4")])
    now = F.lit(dt.datetime(2026, 5, 30, 10, 0, 0, 123456)).cast("timestamp")
    msgs = to_messages(rows, now, late_offset_s=500).collect()
    body = json.loads(msgs[0].value)
    assert body["event_timestamp"] == "2026-05-30T09:51:40.123Z"
    assert body["source_system"] == "stream" and "campaign_id" in body  # nulls kept as null
    back = decode_orders(spark.createDataFrame([(m.value,) for m in msgs], "value string"))
    assert sorted(r.order_id for r in back.collect()) == ["R1", "R2"]


def test_pending_skips_landed_and_rejected_ids(spark):
    rows = text_df(spark, [row(order_id=i) for i in ("P1", "P2", "P3", "P4")])
    good = spark.createDataFrame([("P1",)], "order_id string")
    errors = spark.createDataFrame(
        [("e1", json.dumps({"order_id": "P2"}), "r", "stream", None),
         ("e2", '{"order_id": "P3', "r", "stream", None),          # cut JSON: id not seen
         ("e3", json.dumps({"order_id": "P4"}), "r", "batch", None)],  # other source
        "error_id string, raw_row string, error_reason string, source_system string, logged_at timestamp")
    assert [r.order_id for r in error_order_ids(errors).collect()] == ["P2"]
    assert sorted(r.order_id for r in pending_rows(rows, good, errors).collect()) == ["P3", "P4"]
    assert pending_rows(rows, None, None).count() == 4  # missing tables tolerated


def test_materialize_kinds(spark, tmp):
    df = spark.createDataFrame([("a", dt.date(2026, 1, 1), 1)], "order_id string, order_date date, v int")
    assert materialize(df, "view", "m_view").count() == 1
    assert spark.table("m_view").count() == 1
    t = materialize(df, "table", "m_table", root=tmp, layer=" reporting ")
    assert os.path.isdir(os.path.join(tmp, "reporting", "m_table")) and t.count() == 1
    upd = spark.createDataFrame([("a", dt.date(2026, 1, 1), 2), ("b", dt.date(2026, 1, 2), 3)],
                                "order_id string, order_date date, v int")
    materialize(df, "incremental", "m_inc", root=tmp, keys=["order_id"], partition_by="order_date")
    out = materialize(upd, "incremental", "m_inc", root=tmp, keys=["order_id"], partition_by="order_date")
    assert sorted((r.order_id, r.v) for r in out.collect()) == [("a", 2), ("b", 3)]
