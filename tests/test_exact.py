"""Exact sums against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest

from ordermill.functions import exact
from ordermill.operators.exact_agg import exact_group

ODD = [1e18, -1e18, 1e13, 0.005, -0.005, 1e-300, 5e-324, -5e-324, 1e300, -1e300, 1.7e308, 2.0 ** 54, 2.0 ** 54 + 4,
       2.0 ** 53 + 2, 0.125, -0.125, 0.0, -0.0, 2.0 ** 21, 2.0 ** 42 - 0.0625, math.nextafter(2.0 ** 21, 0)]


def _value(rnd, kind):
    return [lambda: round(rnd.uniform(-1e4, 1e5), 2), lambda: rnd.choice(ODD),
            lambda: math.ldexp(rnd.uniform(-1, 1), rnd.randint(-1074, 1023)), lambda: rnd.randint(-10**6, 10**6) / 8,
            lambda: rnd.choice([float("nan"), float("inf"), float("-inf"), 1.0, None])][kind]()


def _rounded(q, digits):
    if abs(q) >= 2 ** 54:
        try:
            return float(q)
        except OverflowError:
            return math.inf if q > 0 else -math.inf
    v = float(Fraction((2 * 10 ** digits * abs(q) + 1) // 2, 10 ** digits))
    return -v if q < 0 and v else v


@pytest.mark.parametrize("parts", [1, 5])
def test_sums_and_averages(spark, parts):
    rnd = random.Random(5)
    rows = []
    for g in range(250):
        kind = g % 5
        values = [_value(rnd, kind) for _ in range(rnd.randint(1, 12))]
        if kind in (1, 2) and rnd.random() < .5:           # what cancels leaves the rest exact
            values += [-v for v in values] + [_value(rnd, 0)]
        rows += [(g, x, rnd.choice([None, 1, 2, 3, 2**62])) for x in values]
    got = exact_group(spark.createDataFrame(rows, "g int, x double, w long").repartition(parts), ["g"], ("x",), "w", ("w",))
    got = got.select("g", "rows", "ids", exact.sum_round("x", 2).alias("s"), exact.avg_round("x", 2).alias("a"), "w")
    for r in got.collect():
        mine = [(x, w) for g, x, w in rows if g == r["g"]]
        values, ids = [x for x, _ in mine if x is not None], [w for _, w in mine if w is not None]
        assert (r["rows"], r["ids"]) == (len(mine), len(set(ids)))
        assert (r["w"]["n"], r["w"]["s"] or 0) == (len(ids), sum(ids))
        if not values:
            want = None, None
        elif not all(map(math.isfinite, values)):
            want = (sum(values),) * 2
        else:
            total = sum(map(Fraction, values))
            want = _rounded(total, 2), _rounded(total / len(values), 2)
        assert repr((r["s"], r["a"])) == repr(want)


def test_no_rows_and_null_keys(spark):
    empty = spark.createDataFrame([], "k string, x double")
    total = exact_group(empty, [], ("x",), "k").select("rows", "ids", exact.sum_round("x", 2).alias("s")).first()
    assert tuple(total) == (0, 0, None)
    assert exact_group(empty, ["k"], ("x",)).count() == 0
    null = exact_group(spark.createDataFrame([(None, 1.5), (None, 2.0)], "k string, x double"), ["k"], ("x",))
    assert tuple(null.select("k", "rows", exact.sum_round("x", 1)).first()) == (None, 2, 3.5)
