"""Panes: early, on-time and late firings, the earliest copy of each, replay."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.streaming.orders_stream import start
from ordermill.streaming.panes import next_pane
from tests.helpers import GOOD

MIN = 60_000_000


def test_panes_of_a_window():
    state, seen = (0, 0), []
    for at in (5, 20, 34, 35, 50, 64, 66, 200, 200, 201):      # seconds; a window that ends at 66
        opened = next_pane(*state, at * 1_000_000, 66_000_000, 30_000_000)
        if opened:
            seen.append((at, opened[0], opened[2]))
            state = opened[:2]
    assert seen == [(5, 1, "early"), (35, 2, "early"), (66, 3, "late"), (200, 4, "late"), (201, 5, "late")]
    assert next_pane(0, 0, 40 * 10**6, 66 * 10**6, 30 * 10**6) == (1, 66 * 10**6, "on time")
    assert next_pane(0, 0, 7, None, 5) == (1, 0, None) and next_pane(1, 0, 9, None, 5) is None


def _msg(order_id, event, **over):
    return json.dumps(dict(GOOD, order_id=order_id, source_system="stream", event_timestamp=f"2026-05-30T{event}.000Z", **over))


class Run:
    def __init__(self, spark, tmp):
        self.spark, self.tmp, self.files = spark, tmp, 0
        os.makedirs(f"{tmp}/in")

    def put(self, *lines):
        self.files += 1
        name = f"{self.tmp}/in/{self.files:03d}.json"
        with open(name, "w") as f:
            f.writelines(json.dumps({"value": v, "arrival": f"2026-05-30 {a}"}) + "\n" for v, a in lines)
        os.utime(name, (1_700_000_000 + self.files,) * 2)

    def go(self):
        stream = (self.spark.readStream.schema("value string, arrival string").option("maxFilesPerTrigger", 1)
                  .json(f"{self.tmp}/in").withColumn("arrival_ts", F.to_timestamp("arrival")))
        q = start(stream, f"{self.tmp}/good", f"{self.tmp}/bad", f"{self.tmp}/ck", trigger={"availableNow": True}, early_s=30)
        ended = q.awaitTermination(90)
        q.stop()
        assert ended and q.exception() is None
        return sorted((r["order_id"], r["pane"], r["firing"], r["customer_city"], r["ingestion_timestamp"].strftime("%H:%M:%S"))
                      for r in self.spark.read.parquet(f"{self.tmp}/good").collect())


@pytest.fixture()
def run(spark, tmp):
    return Run(spark, tmp)


def test_stream_fires_numbered_panes_and_replays_them(spark, tmp, run):
    run.put((_msg("A", "10:00:10", customer_city="second"), "10:00:22"), (_msg("A", "10:00:10", customer_city="first"), "10:00:20"),
            (_msg("B", "10:00:50"), "10:00:55"), ("not json", "10:00:30"), ("not json", "10:00:31"))
    run.put((_msg("A", "10:00:15", customer_city="covered"), "10:00:49"), (_msg("A", "10:00:16", customer_city="third"), "10:00:51"),
            ("not json", "10:00:52"), (_msg("A", "10:01:10", customer_city="next window"), "10:01:12"))
    run.put((_msg("A", "10:00:17", customer_city="late"), "10:04:00"), (_msg("A", "10:00:00", customer_city="too late"), "10:06:01"),
            (_msg("C", "10:30:00", customer_city="future", campaign_id=""), "10:04:01"))
    want = [("A", 1, "early", "first", "10:00:20"), ("A", 1, "early", "next window", "10:01:12"),
            ("A", 2, "on time", "third", "10:00:51"), ("A", 3, "late", "late", "10:04:00"),
            ("B", 1, "on time", GOOD["customer_city"], "10:00:55"), ("C", 1, "early", "future", "10:04:01")]
    assert run.go() == want
    reasons = sorted(r["error_reason"][:20] for r in spark.read.parquet(f"{tmp}/bad").collect())
    assert reasons == ["event arrived too la", "message is not a JSO"]
    back = spark.read.parquet(f"{tmp}/good").where("order_id = 'C'").first()
    assert back["campaign_id"] is None and str(back["event_timestamp"]) == "2026-05-30 10:30:00"
    # the last batch was written but not committed: it is replayed from the state before it
    for kind in ("commits", "offsets"):
        done = max(int(n) for n in os.listdir(f"{tmp}/ck/{kind}") if n.isdigit())
        last = 2 if kind == "commits" else 3
        for n in range(last, done + 1):
            for name in (str(n), f".{n}.crc"):
                if os.path.exists(f"{tmp}/ck/{kind}/{name}"):
                    os.remove(f"{tmp}/ck/{kind}/{name}")
    assert run.go() == want
    run.put((_msg("A", "10:00:18", customer_city="later"), "10:05:00"))
    assert run.go() == sorted(want + [("A", 4, "late", "later", "10:05:00")])


def test_records_round_trip_with_event_time_header(spark, tmp):
    from ordermill.plans.replay import publish, to_messages
    from ordermill.sources.messages import RECORD_SCHEMA, decode_orders, read_record_stream, records_as_messages
    from tests.helpers import row, text_df
    publish(to_messages(text_df(spark, [row(order_id="R1"), row(order_id="R2")])), f"{tmp}/in", fmt="parquet")
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()[0]
    body = {k: v for k, v in GOOD.items()}
    only_header = json.dumps(dict(body, order_id="R3", source_system="stream"))          # no event time in the payload
    wrong = json.dumps(dict(body, order_id="R4", source_system="stream", event_timestamp=now))
    header = lambda v: [("event_timestamp", v.encode()), ("other", b"x")]
    rows = [("R3", only_header, header(now)), ("R4", wrong, header("no time")), ("R5", wrong.replace("R4", "R5"), None)]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    q = start(read_record_stream(spark, f"{tmp}/in"), f"{tmp}/good", f"{tmp}/bad", f"{tmp}/ck", trigger={"availableNow": True})
    assert q.awaitTermination(120) and q.exception() is None
    assert sorted(r["order_id"] for r in spark.read.parquet(f"{tmp}/good").collect()) == ["R1", "R2", "R3", "R5"]
    bad = spark.read.parquet(f"{tmp}/bad").collect()
    assert len(bad) == 1 and bad[0]["error_reason"].startswith("invalid event_timestamp")     # the header goes first
    batch = decode_orders(records_as_messages(spark.read.schema(RECORD_SCHEMA).parquet(f"{tmp}/in")))
    assert batch.where("order_id = 'R3'").first()["event_timestamp"] == now


def test_odd_json_is_no_order(spark):
    from ordermill.sources.messages import decode_orders
    texts = ['{"order_id":"A","nested":{"x":[1,2]}}', "null", "", "  ", "[]", "{}", '[{"order_id":"A"}]', '{"order_id":"A"},', '"s"', "1",
             '{"order_id":"A","quantity":}', '{"order_id":"A"', None, '{"order_id":{"a":1}}', '{"order_id":5,"quantity":[1]}']
    got = decode_orders(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [r["_not_object"] for r in got] == [t not in (texts[0], "{}", texts[-1], texts[-2]) for t in texts]
    assert [got[-2]["order_id"], got[-1]["order_id"], got[-1]["quantity"]] == ['{"a":1}', "5", "[1]"]
