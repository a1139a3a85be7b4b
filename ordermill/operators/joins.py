"""Star joins.

The join strategy is left to the optimizer: adaptive execution turns a
shuffle join into a broadcast join when the measured size of the dimension
allows it, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def star_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """fact JOIN dim USING (key)."""
    return fact.join(dim, key, how)
