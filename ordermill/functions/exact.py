"""Exact sums of doubles.

Every double is a whole number times a power of two.  A value x is put into
the exponent bin b with |x| in about [2^(21 b), 2^(21 (b + 1))) and written as

    x = (p3 * 2^63 + p2 * 2^42 + p1 * 2^21 + p0) * 2^(21 (b - 3))

with whole parts of 21 bits (p3 may have 22).  The parts of a bin add up as
longs, in any order and with partial sums, without rounding (up to 2^40 rows a
group; an overflow beyond fails the job).  NaN and the infinities have bins of
their own.

The bins of a group (at most 100) are then one long number: carries run
through digits of 21 bits, and the sum or average is rounded once.  Results
below 2^54 in size are rounded half away from zero to the decimals asked for;
larger ones have no decimals as doubles and are the nearest double of the
exact value.  A NaN, or both infinities, make NaN; one infinity makes that
infinity.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 21
MASK = (1 << WIDTH) - 1
NAN, PLUS, MINUS = 1000, 1001, 1002        # the bins of what is not finite
PARTS = ("p3", "p2", "p1", "p0")

# The expressions are SQL texts over column names: as one text each they reach
# the JVM in one call, where composing columns takes thousands.
_names = count()
_DIGITS = "CAST(array() AS ARRAY<BIGINT>)"


def exponent_bin(x: str) -> str:
    """The bin of a double; null for null."""
    return (f"CASE WHEN isnan({x}) THEN {NAN} WHEN {x} = double('inf') THEN {PLUS} WHEN {x} = double('-inf') THEN {MINUS} "
            f"WHEN {x} = 0 THEN 0 WHEN {x} IS NOT NULL THEN CAST(floor(log2(abs({x})) / {WIDTH}) AS INT) END")


def scaled(x: str, b: str) -> str:
    """x * 2^(-21 bin), exact (in two steps, as 2^(21 * 50) is no double)."""
    half = f"floor({b} / 2)"
    return (f"CASE WHEN {b} < {NAN} AND {x} <> 0 THEN {x} * pow(2D, {half} * -{WIDTH}) * pow(2D, ({b} - {half}) * -{WIDTH}) "
            f"ELSE 0D END")


def parts(y: str, r: str) -> list[str]:
    """p3, p2, p1, p0 of a scaled value y and its fraction r = y - floor(y), as longs."""
    q2, q1 = f"floor({r} * {1 << 21}D)", f"floor({r} * {1 << 42}D)"
    return [f"floor({y})", q2, f"{q1} - {q2} * {1 << 21}", f"CAST(({r} * {1 << 42}D - CAST({q1} AS DOUBLE)) * {1 << 21}D AS BIGINT)"]


def _whole(x) -> str:
    return f"CAST({x} AS DECIMAL(38,0))"


def _bind(value: str, use) -> str:
    """``use(name)`` with the value computed once under that name."""
    v = f"v{next(_names)}"
    return f"get(transform(array({value}), {v} -> {use(v)}), 0)"


def _digits(bins: str, lo: str, hi: str, sign: int) -> str:
    """carry (-1 when the number is negative) and its digits of 21 bits, lowest first."""
    p3, p2, p1, p0 = (f"({sign} * e.{p})" for p in PARTS)
    low, high = "({} & %dL)" % MASK, "shiftright({}, %d)" % WIDTH
    place = (f"CASE e.b - k WHEN 3 THEN {low.format(p0)} WHEN 2 THEN {low.format(p1)} + {high.format(p0)} "
             f"WHEN 1 THEN {low.format(p2)} + {high.format(p1)} WHEN 0 THEN {low.format(p3)} + {high.format(p2)} "
             f"WHEN -1 THEN {high.format(p3)} ELSE 0L END")

    def cut(t):
        return f"named_struct('carry', shiftright({t}, {WIDTH}), 'digits', concat(acc.digits, array({t} & {MASK}L)))"
    t = f"aggregate({bins}, acc.carry, (s, e) -> s + {place})"
    return f"aggregate(sequence({lo}, {hi}), named_struct('carry', 0L, 'digits', {_DIGITS}), (acc, k) -> {_bind(t, cut)})"


def _scaled_digits(digits: str, lo: str, factor: int, plus: str) -> str:
    """Digits of number * factor + plus (a whole number below 2^53)."""
    def cut(t):
        return (f"named_struct('k', acc.k + 1, 'carry', shiftright({t}, {WIDTH}), "
                f"'digits', concat(acc.digits, array({t} & {MASK}L)))")
    t = f"d * {factor}L + acc.carry + CASE WHEN acc.k = 0 THEN {plus} ELSE 0L END"
    return (f"aggregate({digits}, named_struct('k', CAST({lo} AS INT), 'carry', 0L, 'digits', {_DIGITS}), "
            f"(acc, d) -> {_bind(t, cut)}).digits")


def _divided(digits: str, lo: str, by: str) -> str:
    """rest and whole quotient digits (highest first) of the digits from 2^0 up, divided by a whole number."""
    def cut(t):
        return f"named_struct('rest', {t} % ({by}), 'digits', concat(acc.digits, array({t} div ({by}))))"
    return (f"aggregate(reverse(slice({digits}, 1 - {lo}, size({digits}))), named_struct('rest', 0L, 'digits', {_DIGITS}), "
            f"(acc, d) -> {_bind(f'acc.rest * {1 << WIDTH}L + d', cut)})")


def _joined(digits: str) -> str:
    return f"aggregate({digits}, {_whole(0)}, (n, d) -> {_whole(f'n * {1 << WIDTH}L + d')})"


def _nearest(quotient: str, lower: str) -> str:
    """Nearest double of a whole number of at least 55 bits (digits highest first, and
    whether anything nonzero lies below them)."""
    lead = f"get(filter(transform({quotient}, (d, i) -> CASE WHEN d > 0 THEN i END), i -> i IS NOT NULL), 0)"

    def value(first):
        sticky = f"{lower} OR exists(slice({quotient}, {first} + 5, size({quotient})), d -> d > 0)"
        top = _joined(f"slice({quotient}, {first} + 1, 4)")
        return (f"CAST({_whole(f'{top} * 2 + CASE WHEN {sticky} THEN 1 ELSE 0 END')} AS DOUBLE) "
                f"* pow(2D, greatest(size({quotient}) - {first} - 4, 0) * {WIDTH} - 1)")
    return _bind(lead, value)


def _rounded(bins: str, n: str, decimals: int) -> str:
    finite = f"filter({bins}, e -> e.b < {NAN})"
    powers = f"transform({finite}, e -> e.b)"
    lo = f"least(array_min({powers}) - 3, 0)"
    hi = f"greatest(array_max({powers}), 0) + 5"             # room for carries, the decimals and n

    def has(code):
        return f"exists({bins}, e -> e.b = {code})"

    def within(x):                                           # x: finite bins, lo, hi, n
        def value(number):
            def of_size(size):
                def result(quotient):
                    third = f"get({quotient}.digits, size({quotient}.digits) - 3)"         # worth 2^42
                    big = f"({third} >= 4096 OR exists(slice({quotient}.digits, 1, size({quotient}.digits) - 3), d -> d > 0))"
                    below = f"({quotient}.rest <> 0 OR exists(slice({size}, 1, -{x}.lo), d -> d > 0))"
                    twice = _scaled_digits(size, f"{x}.lo", 2 * 10 ** decimals, f"{x}.n")
                    units = _bind(twice, lambda t: _joined(_divided(t, f"{x}.lo", f"{x}.n * 2") + ".digits"))
                    small = f"CAST(CAST({units} AS DECIMAL(28,0)) * {10.0 ** -decimals:.{decimals}f}BD AS DOUBLE)"
                    return f"CASE WHEN {big} THEN {_nearest(f'{quotient}.digits', below)} ELSE {small} END"
                return _bind(_divided(size, f"{x}.lo", f"{x}.n"), result)
            minus = _digits(f"{x}.bins", f"{x}.lo", f"{x}.hi", -1)
            size = f"CASE WHEN {number}.carry < 0 THEN {minus}.digits ELSE {number}.digits END"
            return _bind(_bind(size, of_size), lambda v: f"CASE WHEN {number}.carry < 0 AND {v} > 0 THEN -{v} ELSE {v} END")
        return _bind(_digits(f"{x}.bins", f"{x}.lo", f"{x}.hi", 1), value)
    state = f"named_struct('bins', {finite}, 'lo', {lo}, 'hi', {hi}, 'n', {n})"
    return (f"CASE WHEN {has(NAN)} OR ({has(PLUS)} AND {has(MINUS)}) THEN double('nan') WHEN {has(PLUS)} THEN double('inf') "
            f"WHEN {has(MINUS)} THEN double('-inf') WHEN size({bins}) > 0 THEN {_bind(state, within)} END")


def sum_round(bins: str, decimals: int) -> Column:
    """round(sum, decimals) of a column of bins; null for a group without values."""
    return F.expr(_rounded(bins, "1L", decimals))


def avg_round(bins: str, decimals: int) -> Column:
    """round(sum / count, decimals) of a column of bins; null for a group without values."""
    return F.expr(_rounded(bins, f"aggregate({bins}, 0L, (n, e) -> n + e.n)", decimals))
