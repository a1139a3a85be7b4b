"""The generated methods of the validation plans, and what their shorter expressions return."""

import pytest

from ordermill.functions import parse
from ordermill.functions.text import raw_line
from ordermill.operators import validate as V
from ordermill.plans.model import Model


def _methods(df):
    """Bytes of the longest generated method of each stage; the JVM compiles none of 8000 or more."""
    parts = df._jdf.queryExecution().debug().codegenToSeq()
    return [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]


@pytest.fixture
def static_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    yield lambda df: (spark.conf.set("spark.sql.adaptive.enabled", "false"), df.select("*"))[1]
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_batch_validation_methods_are_compiled(spark, static_plans):
    found = _methods(static_plans(Model(spark, "/root/testdata/sf0.001").batch_errors))
    assert found and max(found) < 8000


def test_stream_validation_methods_are_compiled(spark, static_plans):
    found = _methods(static_plans(Model(spark, "/root/testdata/sf0.001").stream_errors))
    assert found and max(found) < 8000


def test_number_texts(spark):
    long = {"1_2": 12, " +7 ": 7, "-3\t\n": -3, "1__2": None, "_1": None, "1_": None, "": None, "1 2": None, "99999999999999999999": None}
    double = {"1_0.5": 10.5, ".5": 0.5, "5.": 5.0, "1e5": 1e5, "1_0e1_0": 1e11, ".": None, "1e": None, "1._5": None, "1_.5": None, " -inf\n": float("-inf")}
    df = spark.createDataFrame([(x,) for x in {**long, **double}], "x string")
    got = {r["x"]: r for r in df.select("x", parse.strict_long("x").alias("l"), parse.strict_double("x").alias("d")).collect()}
    assert {x: got[x]["l"] for x in long} == long
    assert {x: got[x]["d"] for x in double} == double


def test_raw_line_and_missing_names(spark):
    df = spark.createDataFrame([("a", None, ""), (None, None, None), ("x", "y", "z")], "a string, b string, c string")
    rows = df.select(raw_line(["a", "b", "c"]).alias("raw"), V._missing_reason(["a", "b"]).alias("why")).collect()
    assert [r["raw"] for r in rows] == ["a,,", ",,", "x,y,z"]
    assert [r["why"] for r in rows] == [V.MISSING + "['b']", V.MISSING + "['a', 'b']", None]
