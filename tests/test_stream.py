"""Stream = batch parity on a file source with availableNow, plus the
lateness and duplicate rules."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ordermill.streaming.orders_stream import start
from tests.helpers import GOOD


def _msg(order_id, event_ts, **over):
    d = dict(GOOD, order_id=order_id, event_timestamp=event_ts, source_system="stream")
    d.update(over)
    return json.dumps(d)


def test_stream_routes_late_and_dedups(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    # messages carry their arrival time (the source column), so the run is reproducible
    lines = [
        (_msg("S1", "2026-05-30T10:00:10.000Z"), "2026-05-30 10:00:20"),   # on time
        (_msg("S1", "2026-05-30T10:00:30.000Z", customer_city="X"), "2026-05-30 10:00:40"),  # dup same window
        (_msg("S1", "2026-05-30T10:01:30.000Z"), "2026-05-30 10:01:40"),   # next window: kept
        (_msg("S2", "2026-05-30T10:00:59.000Z"), "2026-05-30 10:06:40"),   # 341 s late: accepted
        (_msg("S3", "2026-05-30T10:00:00.000Z"), "2026-05-30 10:06:01"),   # 361 s late: error
        (_msg("S4", "2026-05-30T11:00:00.000Z"), "2026-05-30 10:02:00"),   # future: accepted
        ("not json", "2026-05-30 10:02:00"),
        (_msg("S5", "2026-05-30T10:02:00.000Z", quantity="0"), "2026-05-30 10:02:10"),
    ]
    with open(os.path.join(src, "part-0.json"), "w") as f:
        for value, arrival in lines:
            f.write(json.dumps({"value": value, "arrival": arrival}) + "\n")
    stream = (spark.readStream.schema("value string, arrival string").json(src)
              .withColumn("arrival_ts", F.to_timestamp("arrival")))
    good_p, bad_p, ck = (os.path.join(tmp, x) for x in ("good", "bad", "ck"))
    q = start(stream, good_p, bad_p, ck, trigger={"availableNow": True})
    q.awaitTermination(120)
    assert q.exception() is None
    good = spark.read.parquet(good_p).collect()
    bad = spark.read.parquet(bad_p).collect()
    ids = sorted(r.order_id for r in good)
    assert ids == ["S1", "S1", "S2", "S4"]
    s1 = sorted((r.event_timestamp for r in good if r.order_id == "S1"))
    assert s1 == [dt.datetime(2026, 5, 30, 10, 0, 10), dt.datetime(2026, 5, 30, 10, 1, 30)]
    reasons = sorted(r.error_reason for r in bad)
    assert len(bad) == 3
    assert reasons[0].startswith("event arrived too late to process: 361s")
    assert "message is not a JSON object" in reasons and "quantity must be positive" in reasons
    assert len(good) + len(bad) + 1 == len(lines)  # the one in-window duplicate is dropped


def test_reconcile_sink_after_restart(spark, tmp):
    from ordermill.streaming.reconcile import reconcile_sink
    path = os.path.join(tmp, "sink")
    t0, t1 = dt.datetime(2026, 5, 30, 10, 0, 0), dt.datetime(2026, 5, 30, 10, 5, 0)
    rows = [("A", t0, 0), ("A", t1, 1), ("B", t0, 0), ("C", t1, 1), ("C", t1, 2)]
    spark.createDataFrame(rows, "order_id string, ingestion_timestamp timestamp, batch_id int") \
        .write.partitionBy("batch_id").parquet(path)
    out = reconcile_sink(spark, path)
    assert out == {"duplicate_keys_before": 2, "duplicate_keys_after": 0}
    got = sorted((r.order_id, r.ingestion_timestamp) for r in spark.read.parquet(path).collect())
    assert got == [("A", t0), ("B", t0), ("C", t1)]


def test_replay_job_publishes_pending_rows(spark, tmp):
    from ordermill.plans.replay import run_replay
    from ordermill.schemas import ORDER_COLUMNS
    csv = os.path.join(tmp, "orders_new.csv")
    with open(csv, "w") as f:
        f.write(",".join(ORDER_COLUMNS) + "\n")
        for i in range(4):
            f.write(f"N{i},1,2,3,,2026-05-30,1,10.0,5,1.5,UPI,2,0,Delivered,West Hub,4,Pune,MH\n")
    good = spark.createDataFrame([("N0",)], "order_id string")
    out = os.path.join(tmp, "msgs")
    res = run_replay(spark, csv, out, good, None, F.lit(dt.datetime(2026, 5, 30, 10)).cast("timestamp"), 500)
    assert res == {"rows": 4, "sent": 3, "skipped": 1, "errors_without_id": 0}
    sent = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(m["order_id"] for m in sent) == ["N1", "N2", "N3"]
    assert {m["event_timestamp"] for m in sent} == {"2026-05-30T09:51:40.000Z"}


def test_stream_equals_batch_on_the_events_stand_in(spark, tmp):
    """Same messages through the stream job and through the batch operators:
    the same error ids, and one kept copy per (order_id, 60 s window)."""
    from ordermill.operators import validate as V
    from ordermill.operators.dedup import dedup
    from ordermill.sources import testdata as td
    from ordermill.sources.messages import decode_orders
    from tests.conftest import SF_SMALL

    msgs = td.order_messages(td.Tables(spark, SF_SMALL)).select("value", "arrival_ts")
    src = os.path.join(tmp, "in")
    msgs.select(F.to_json(F.struct("value", F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                                   .alias("arrival"))).alias("j")).coalesce(1).write.text(src)
    stream = (spark.readStream.schema("value string, arrival string").json(src)
              .withColumn("arrival_ts", F.to_timestamp("arrival")))
    good_p, bad_p, ck = (os.path.join(tmp, x) for x in ("good", "bad", "ck"))
    q = start(stream, good_p, bad_p, ck, window_s=60, lateness_s=300, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None

    v = V.validate_orders(decode_orders(msgs), "stream", raw=F.col("value"),
                          arrival_ts=F.col("arrival_ts"), window_s=60, lateness_s=300)
    batch_errors = {r.error_id for r in V.error_rows(v, "stream").collect()}
    stream_errors = {r.error_id for r in spark.read.parquet(bad_p).collect()}
    assert stream_errors == batch_errors and len(batch_errors) > 0

    win = lambda df: df.withColumn("w", F.window("event_timestamp", "60 seconds").start)
    batch_keys = {(r.order_id, r.w) for r in dedup(win(v.where("error_reason is null")),
                                                   ["order_id", "w"], ["arrival_ts"]).collect()}
    stream_rows = win(spark.read.parquet(good_p)).collect()
    assert {(r.order_id, r.w) for r in stream_rows} == batch_keys
    assert len(stream_rows) == len(batch_keys)


def test_stream_refuses_incompatible_sink(spark, tmp):
    import pytest
    good = os.path.join(tmp, "good")
    spark.createDataFrame([("x", "y")], "order_id string, customer_id string").write.parquet(good)
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    stream = spark.readStream.schema("value string").text(src).withColumn("arrival_ts", F.current_timestamp())
    with pytest.raises(ValueError, match="customer_id"):
        start(stream, good, os.path.join(tmp, "bad"), os.path.join(tmp, "ck"))
    with pytest.raises(ValueError, match="does not exist"):
        start(stream, os.path.join(tmp, "g2"), os.path.join(tmp, "b2"), os.path.join(tmp, "ck2"),
              sinks_must_exist=True)


def test_multi_batch_stream_drops_nothing_by_watermark(spark, tmp):
    """Messages arrive over many micro-batches (one file per day, in arrival
    order): the watermark advances, yet no row passing the lateness guard is
    dropped by it, and the result still equals the batch operators'."""
    from ordermill.operators import validate as V
    from ordermill.operators.dedup import dedup
    from ordermill.sources import testdata as td
    from ordermill.sources.messages import decode_orders
    from tests.conftest import SF_SMALL

    msgs = td.order_messages(td.Tables(spark, SF_SMALL)).select("value", "arrival_ts")
    stage = os.path.join(tmp, "stage")
    (msgs.withColumn("day", F.date_format("arrival_ts", "yyyy-MM-dd"))
     .select("day", F.to_json(F.struct("value", F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                                       .alias("arrival"))).alias("j"))
     .repartition("day").write.partitionBy("day").text(stage))
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    days = sorted(d for d in os.listdir(stage) if d.startswith("day="))
    for i, d in enumerate(days):
        for f in os.listdir(os.path.join(stage, d)):
            if f.endswith(".txt"):
                dst = os.path.join(src, f"{i:03d}-{f}")
                os.link(os.path.join(stage, d, f), dst)
                os.utime(dst, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    stream = (spark.readStream.schema("value string, arrival string").option("maxFilesPerTrigger", 1)
              .json(src).withColumn("arrival_ts", F.to_timestamp("arrival")))
    good_p, bad_p, ck = (os.path.join(tmp, x) for x in ("good", "bad", "ck"))
    q = start(stream, good_p, bad_p, ck, trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    progress = q.recentProgress
    assert len(progress) >= 5
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in progress for op in p.get("stateOperators", []))
    assert dropped == 0

    v = V.validate_orders(decode_orders(msgs), "stream", raw=F.col("value"),
                          arrival_ts=F.col("arrival_ts"))
    win = lambda df: df.withColumn("w", F.window("event_timestamp", "60 seconds").start)
    want = {(r.order_id, r.w) for r in dedup(win(v.where("error_reason is null")),
                                             ["order_id", "w"], ["arrival_ts"]).collect()}
    got = win(spark.read.parquet(good_p)).collect()
    assert {(r.order_id, r.w) for r in got} == want and len(got) == len(want)
    assert spark.read.parquet(bad_p).count() == V.error_rows(v, "stream").count()


def test_restart_replays_a_batch_without_duplicates(spark, tmp):
    from ordermill.operators.dedup import duplicate_keys
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(20):
            f.write(json.dumps({"value": _msg(f"R{i}", "2026-05-30T10:00:10.000Z"),
                                "arrival": "2026-05-30 10:00:20"}) + "\n")

    def run():
        stream = (spark.readStream.schema("value string, arrival string").json(src)
                  .withColumn("arrival_ts", F.to_timestamp("arrival")))
        q = start(stream, good_p, bad_p, ck, trigger={"availableNow": True})
        q.awaitTermination(120)
        assert q.exception() is None
        q.stop()
        return sum(p["numInputRows"] for p in q.recentProgress)

    good_p, bad_p, ck = (os.path.join(tmp, x) for x in ("good", "bad", "ck"))
    run()
    # crash after writing batch 0, before its commit: batch 0 is planned
    # (offsets/0) but not committed, and nothing was planned after it
    for d, n in (("commits", "0"), ("commits", "1"), ("offsets", "1")):
        for name in (n, f".{n}.crc"):
            if os.path.exists(os.path.join(ck, d, name)):
                os.remove(os.path.join(ck, d, name))
    assert run() == 20                              # the batch is replayed
    good = spark.read.parquet(good_p)
    assert good.count() == 20
    assert duplicate_keys(good, ["order_id"]).count() == 0
