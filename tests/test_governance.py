from ordermill.operators.governance import ColumnMask, RowPolicy, governed


def _fact(spark):
    return spark.createDataFrame([("o1", "West Hub", 10.0), ("o2", "East Hub", 20.0)],
                                 "order_id string, warehouse_region string, revenue double")


POLICY = RowPolicy("west", frozenset({"ana"}), "warehouse_region = 'West Hub'")
MASK = ColumnMask(("revenue",), frozenset({"fin"}))


def test_row_policy_and_mask_together(spark):
    df = _fact(spark)
    out = governed(df, "ana", [POLICY], [MASK])
    assert out.schema == df.schema
    assert [tuple(r) for r in out.collect()] == [("o1", "West Hub", None)]


def test_reader_of_masked_column_sees_values(spark):
    out = governed(_fact(spark), "fin", [], [MASK]).collect()
    assert sorted(r.revenue for r in out) == [10.0, 20.0]


def test_no_grant_means_no_rows(spark):
    assert governed(_fact(spark), "bob", [POLICY], []).count() == 0
