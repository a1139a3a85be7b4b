"""Calendar parts of a date, as the date dimension exposes them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output formats.
DAY_NAME_FORMAT = "EEEE"        # Monday
MONTH_NAME_FORMAT = "MMMM"      # January
DISPLAY_FORMAT = "dd-MMM-yyyy"  # 03-May-2026


def calendar_parts(d: Column) -> dict:
    """year, month, day, quarter, day_of_week (1 = Sunday), day_name, month_name."""
    return {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day": F.dayofmonth(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "day_of_week": F.dayofweek(d).cast("bigint"),
        "day_name": F.date_format(d, DAY_NAME_FORMAT),
        "month_name": F.date_format(d, MONTH_NAME_FORMAT),
    }


def display_date(d: Column) -> Column:
    return F.date_format(d, DISPLAY_FORMAT)


def window_start(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling window of ``seconds`` holding ts
    (the value of window(ts, ...).start).  Plain arithmetic: unlike window(),
    it adds no not-null filter on ts, so rows without an event time stay."""
    size = F.lit(seconds * 1_000_000)
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, size))
