"""Money and ratio arithmetic.

Money is stored as double, as in the raw tables.  A row's revenue is the
double formula, rounded half away from zero by fixed IEEE steps.  Sums and
averages of doubles are in ``functions.exact``; ratios of whole numbers are
rounded once here, by integer half-up division.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def revenue(quantity="quantity", unit_price="unit_price", discount="discount") -> Column:
    """round(quantity * unit_price * (1 - discount / 100), 2).

    sign * floor(|x| * 100 + 0.5) / 100 in doubles; from 1e13 on (where a
    double holds no more than cents anyway), NaN and infinity stay as they are."""
    x = _col(quantity).cast("double") * _col(unit_price) * (F.lit(1.0) - _col(discount) / F.lit(100.0))
    cents = F.floor(F.abs(x) * 100 + 0.5).cast("double")
    return F.when(F.abs(x) < 1e13, F.signum(x) * cents / 100).otherwise(x)


def units(c, scale: int) -> Column:
    """Value as a whole number of 10^-scale units (exact for values with at
    most `scale` decimals), typed DECIMAL(20,0) so sums never overflow."""
    return F.round(_col(c) * (10 ** scale), 0).cast("decimal(20,0)")


def avg_round(c, digits: int) -> Column:
    """round(avg(c), digits) as a plain aggregate, for values with at most six
    decimals more than the result: other doubles go through ``functions.exact``."""
    s = F.sum(units(c, digits + 6))
    n = F.count(_col(c)).cast("decimal(20,0)") * F.lit(10 ** 6).cast("decimal(7,0)")
    return (_round_div(s, n) / (10 ** digits)).cast("double")


def ratio_round(num: Column, den: Column, digits: int, factor: int = 1) -> Column:
    """round(num / den * factor, digits) for integral num, den (den > 0)."""
    n = (num.cast("decimal(38,0)") * F.lit(Decimal(factor * 10 ** digits))).cast("decimal(38,0)")
    return (_round_div(n, den.cast("decimal(20,0)")) / (10 ** digits)).cast("double")


def _round_div(num: Column, den: Column) -> Column:
    # Half-up rounding of num / den as floor((2|num| + den) / 2den), sign
    # restored.  The floor is taken as (x - x % y) / y: DECIMAL remainder is
    # exact and the division of an exact multiple is exact, so no rounding of
    # an intermediate quotient can carry across an integer.
    den = F.when(den > 0, den)  # no values: null, as avg() gives
    x = F.abs(num) * 2 + den
    y = den * 2
    mag = ((x - x % y) / y).cast("decimal(38,0)")
    return F.when(num >= 0, mag).otherwise(-mag)
