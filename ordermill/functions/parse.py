"""Strict text-to-type parsing with the rules of the ingest contract.

Each parser returns null when the text is not acceptable.  All use try_* casts so that ANSI mode never raises inside a job.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text shapes.
#   integer:   optional blanks, sign, digits with single '_' between digits
#   float:     decimal or exponent notation with the same digit groups, or
#              inf / infinity / nan in any case
#   date:      yyyy-m-d (1-2 digit month and day)
#   event ts:  yyyy-m-dTh:m:s.fZ with 1 to 6 fraction digits, fraction required
# Possessive repeats: what follows a run of digits or blanks cannot begin inside it.
INT_PATTERN = r"^\s*+[+-]?\d(?:_?\d)*+\s*+$"
FLOAT_PATTERN = (r"^\s*+[+-]?(?:(?:(?:\d(?:_?\d)*+)?\.\d(?:_?\d)*+|\d(?:_?\d)*+\.?)(?:[eE][+-]?\d(?:_?\d)*+)?"
                 r"|(?i:inf|infinity|nan))\s*+$")
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
DATE_FORMAT = "yyyy-M-d"
EVENT_TS_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$"
EVENT_TS_FORMAT = "yyyy-M-d'T'H:m:s.SSSSSS'Z'"
EVENT_TS_WRITE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _ungrouped(c: Column) -> Column:
    """Digits without the marks between groups (no regular expression: its generated code is long)."""
    return F.replace(c, F.lit("_"), F.lit(""))


def strict_long(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(INT_PATTERN), _ungrouped(c).try_cast("bigint"))


def strict_double(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(FLOAT_PATTERN), _ungrouped(c).try_cast("double"))


def lenient_long(c) -> Column:
    """int(float(text)): parse as a float, truncate toward zero; nan/inf fail."""
    return strict_double(c).try_cast("bigint")


def strict_date(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(DATE_PATTERN), F.try_to_date(c, DATE_FORMAT))


def strict_event_ts(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(EVENT_TS_PATTERN), F.try_to_timestamp(c, F.lit(EVENT_TS_FORMAT)))


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(c != "", c)
