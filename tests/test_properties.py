"""Properties: validation partitions its input; keep-one-per-key is exact
and idempotent; upsert keeps one row per key."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.operators.dedup import dedup
from ordermill.operators.upsert import upsert
from tests.helpers import row, text_df

texts = st.one_of(st.none(), st.sampled_from(["", "0", "-1", "7", " 12 ", "1_0", "12.0", "abc", "1e3",
                                              "2026-5-3", "2026-02-30", "nan", "3.5"]))

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(texts, texts, texts, texts), min_size=1, max_size=12))
def test_every_row_is_good_or_error_once(spark, cells):
    rows = [row(order_id=f"o{i}", customer_id=a, quantity=b, unit_price=c, order_date=d)
            for i, (a, b, c, d) in enumerate(cells)]
    v = V.validate_orders(text_df(spark, [tuple(x if x is not None else None for x in r) for r in rows]),
                          "batch")
    good, bad = V.split(v, "batch", F.lit("2026-06-01 00:00:00").cast("timestamp"))
    g = {r.order_id for r in good.collect()}
    b = {r.raw_row.split(",")[0] for r in bad.collect()}
    assert g.isdisjoint(b) and len(g) + len(b) == len(rows)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=40))
def test_keep_one_per_key(spark, pairs):
    df = spark.createDataFrame([(f"k{k}", v, i) for i, (k, v) in enumerate(pairs)], "k string, v int, pos int")
    once = dedup(df, ["k"], ["v"], keep="last", tie_break=["pos"])
    got = {r.k: (r.v, r.pos) for r in once.collect()}
    want = {}
    for i, (k, v) in enumerate(pairs):
        cur = want.get(f"k{k}")
        if cur is None or v > cur[0] or (v == cur[0] and i < cur[1]):
            want[f"k{k}"] = (v, i)
    assert got == want
    assert sorted(dedup(once, ["k"], ["v"], keep="last", tie_break=["pos"]).collect()) == sorted(once.collect())
    merged = upsert(once, df.where("v % 2 = 0").dropDuplicates(["k"]), ["k"])
    assert merged.count() == merged.select("k").distinct().count()
