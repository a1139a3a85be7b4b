"""What the quality plans share, and null keys."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import quality as Q
from ordermill.operators.dedup import dedup


@pytest.fixture
def static_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    yield lambda df: (spark.conf.set("spark.sql.adaptive.enabled", "false"), df.select("*"))[1]
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_unique_check_shares_the_exchange_of_the_dedup(spark, static_plans):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    fact = dedup(rows, ["k"], ["v"])
    plan = static_plans(Q.unique_failures(fact, "k"))._jdf.queryExecution().executedPlan().toString()
    assert "Filter isnotnull(k" not in plan


def test_unique_failures_ignore_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, None), (2, None), (3, 3)], "a int, b int")
    assert [tuple(r) for r in Q.unique_failures(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert sorted(map(tuple, Q.unique_failures(df, "a").collect())) == [(1, 2), (2, 2)]
