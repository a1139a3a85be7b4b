"""Text helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading/trailing whitespace of any kind (space, tab, newline, ...).
# Spark's own trim() strips spaces only.
_EDGE_WS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def trim_ws(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, _EDGE_WS, "")


def raw_line(columns) -> Column:
    """Rebuild the raw CSV line: values joined by ',' (no re-quoting).
    A null field renders as the empty string so columns never shift."""
    return F.array_join(F.array(*columns), ",", "")


def truncate(c, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, 1, n)
