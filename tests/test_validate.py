import datetime as dt
import json

from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.plans import staging
from ordermill.sources.messages import decode_orders
from tests.helpers import GOOD, row, text_df


def reasons(spark, rows):
    v = V.validate_orders(text_df(spark, rows), "batch")
    return {r.order_id: r.error_reason for r in v.select("order_id", "error_reason").collect()}


def test_good_row_is_typed(spark):
    v = V.validate_orders(text_df(spark, [row()]), "batch")
    good = V.good_rows(v, "batch", F.lit(dt.datetime(2026, 6, 1)).cast("timestamp")).first()
    assert good.customer_id == 632 and good.unit_price == 4837.64
    assert good.order_date == dt.date(2026, 5, 30) and good.campaign_id is None
    assert good.source_system == "batch"


def test_missing_fields_are_named(spark):
    r = reasons(spark, [row(order_id="M1", customer_id=""), row(order_id="M2", product_id=""),
                        row(order_id="M3", order_status="", customer_city="")])
    assert r["M1"] == "missing required field(s): ['customer_id']"
    assert r["M2"] == "missing required field(s): ['product_id']"
    assert r["M3"] == "missing required field(s): ['order_status', 'customer_city']"
    v = V.validate_orders(text_df(spark, [row(order_id="")]), "batch").first()
    assert v.error_reason == "missing required field(s): ['order_id']"


def test_quantity_must_be_positive(spark):
    r = reasons(spark, [row(order_id="Q0", quantity="0"), row(order_id="Q1", quantity="-1")])
    assert r == {"Q0": V.QTY_NOT_POSITIVE, "Q1": V.QTY_NOT_POSITIVE}


def test_bad_numbers(spark):
    r = reasons(spark, [row(order_id="B1", customer_id="abc"), row(order_id="B2", region_id="xyz"),
                        row(order_id="B3", unit_price="N/A"), row(order_id="B4", quantity="12.0"),
                        row(order_id="B5", discount="1d"), row(order_id="B6", delivery_days="1e3"),
                        row(order_id="OK", customer_id=" 12 ", unit_price="1_000.5")])
    assert r["B1"] == "invalid integer for customer_id"
    assert r["B2"] == "invalid integer for region_id"
    assert r["B3"] == "invalid number for unit_price"
    assert r["B4"] == "invalid integer for quantity"
    assert r["B5"] == "invalid number for discount"
    assert r["B6"] == "invalid integer for delivery_days"
    assert r["OK"] is None


def test_dates(spark):
    r = reasons(spark, [row(order_id="D1", order_date="30-05-2026"),
                        row(order_id="D2", order_date="2026-02-30"),
                        row(order_id="D3", order_date="2026-5-3")])
    assert r["D1"] == V.BAD_DATE and r["D2"] == V.BAD_DATE and r["D3"] is None


def test_campaign_is_lenient(spark):
    v = V.validate_orders(text_df(spark, [row(order_id="C1", campaign_id=""),
                                          row(order_id="C2", campaign_id="3.0"),
                                          row(order_id="C3", campaign_id="3.7"),
                                          row(order_id="C4", campaign_id="x")]), "batch")
    got = {r.order_id: (r.campaign_id, r.error_reason) for r in v.collect()}
    assert got["C1"] == (None, None) and got["C2"] == (3, None) and got["C3"] == (3, None)
    assert got["C4"][1] == "invalid number for campaign_id"


def test_every_row_lands_once_and_errors_keep_raw_text(spark):
    rows = [row(order_id=f"G{i}") for i in range(5)] + [row(order_id="X", quantity="0")]
    v = V.validate_orders(text_df(spark, rows), "batch")
    good, bad = V.split(v, "batch", F.lit(dt.datetime(2026, 6, 1)).cast("timestamp"))
    assert good.count() + bad.count() == len(rows)
    e = bad.first()
    assert e.raw_row.startswith("X,632,238,26,,2026-05-30,0,")
    import hashlib
    assert e.error_id == hashlib.md5(e.raw_row.encode()).hexdigest()


def test_trim_tab_and_newline(spark):
    raw = text_df(spark, [row(payment_method="\tUPI\n", order_status=" Delivered ")])
    v = V.good_rows(V.validate_orders(raw, "batch"), "batch")
    s = staging.stg_orders_batch(v).first()
    assert s.payment_method == "UPI" and s.order_status == "Delivered" and s.source_system == "batch"


def _messages(spark, payloads, arrival):
    return spark.createDataFrame([(p, arrival) for p in payloads], "value string, arrival_ts timestamp")


def _msg(**over):
    d = dict(GOOD, event_timestamp="2026-05-30T10:00:00.000Z")
    d.update(over)
    return json.dumps({k: v for k, v in d.items() if v is not None})


def stream_reasons(spark, payloads, arrival=dt.datetime(2026, 5, 30, 10, 0, 0)):
    m = decode_orders(_messages(spark, payloads, arrival))
    v = V.validate_orders(m, "stream", raw=F.col("value"), arrival_ts=F.col("arrival_ts"))
    return [r.error_reason for r in v.orderBy("value").collect()]


def test_messages_that_are_not_objects(spark):
    assert stream_reasons(spark, ["bad"]) == [V.NOT_OBJECT]
    assert stream_reasons(spark, ["[1]"]) == [V.NOT_OBJECT]


def test_event_timestamp_rules(spark):
    assert stream_reasons(spark, [_msg(event_timestamp=None)]) == [V.BAD_EVENT_TS]
    assert stream_reasons(spark, [_msg(event_timestamp="2026-05-30T10:00:00Z")]) == [V.BAD_EVENT_TS]
    assert stream_reasons(spark, [_msg(event_timestamp="2026-05-30T10:00:00.5Z")]) == [None]


def test_lateness_guard(spark):
    arrival = dt.datetime(2026, 5, 30, 10, 6, 1)  # 361 s after 10:00:00
    late = stream_reasons(spark, [_msg()], arrival)[0]
    assert late.startswith("event arrived too late to process: 361s after event_timestamp")
    assert stream_reasons(spark, [_msg()], dt.datetime(2026, 5, 30, 10, 6, 0)) == [None]
    # future events are accepted
    assert stream_reasons(spark, [_msg()], dt.datetime(2026, 5, 30, 9, 0, 0)) == [None]


def test_sample_file_split(spark):
    """A 37-row order file: 26 distinct good ids, one of them twice with
    different content, and 10 planted bad rows -> 27 good, 10 bad."""
    rows = [row(order_id=f"ORD{i:05d}") for i in range(26)]
    rows.append(row(order_id="ORD00003", customer_city="Other"))
    bad = [row(order_id="S1", customer_id=""), row(order_id="S2", quantity="0"),
           row(order_id="S3", quantity="-1"), row(order_id="S4", customer_id="abc"),
           row(order_id="S5", order_date="30-05-2026"), row(order_id=""),
           row(order_id="S7", unit_price="N/A"), row(order_id="S8", region_id="xyz"),
           row(order_id="S9", product_id=""), row(order_id="S10", order_status="")]
    v = V.validate_orders(text_df(spark, rows + bad), "batch")
    c = V.validation_counts(v).first()
    assert (c.good_rows, c.bad_rows) == (27, 10)
    assert v.where("error_reason is null").select("order_id").distinct().count() == 26


def test_coerce_dimension(spark):
    df = spark.createDataFrame([("1", "10.5", "5"), ("", "1", "1"), ("2", "n/a", "many"), ("3", "2", "1.5")],
                               "product_id string, mrp string, stock_level string")
    spec = {"key": ["product_id"], "int_cols": ["product_id", "stock_level"], "float_cols": ["mrp"]}
    got = {r.product_id: (r.mrp, r.stock_level) for r in V.coerce_dimension(df, spec).collect()}
    assert got == {1: (10.5, 5), 2: (None, None), 3: (2.0, None)}


def test_json_numbers_parse_as_their_text(spark):
    ok = json.loads(_msg())
    ok.update({"customer_id": 632, "unit_price": 10.5})
    frac = dict(ok, customer_id=1.5)
    got = stream_reasons(spark, [json.dumps(ok), json.dumps(frac)])
    assert sorted(got, key=str) == sorted([None, "invalid integer for customer_id"], key=str)
