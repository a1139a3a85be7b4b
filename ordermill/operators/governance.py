"""Governed views: row access policies (filters) and column masks.

A policy grants a set of principals the rows matching a predicate; a
principal sees the union of the rows its policies grant, and a table with
policies shows no rows to a principal without one.  A masked column reads
NULL (same type) for principals outside its reader set.  Both are plain
Column expressions, so Catalyst pushes the row predicate into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowPolicy:
    name: str
    grantees: frozenset
    predicate: object  # Column or SQL text

    def column(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate


@dataclass
class ColumnMask:
    columns: tuple
    readers: frozenset = field(default_factory=frozenset)


def row_filter(df: DataFrame, principal: str, policies: list[RowPolicy]) -> DataFrame:
    if not policies:
        return df
    granted = [p.column() for p in policies if principal in p.grantees]
    if not granted:
        return df.where(F.lit(False))
    return df.where(reduce(lambda a, b: a | b, granted))


def mask_columns(df: DataFrame, principal: str, masks: list[ColumnMask]) -> DataFrame:
    hidden = {c for m in masks if principal not in m.readers for c in m.columns}
    types = dict(df.dtypes)
    return df.withColumns({c: F.lit(None).cast(types[c]) for c in hidden if c in types})


def governed(df: DataFrame, principal: str, policies: list[RowPolicy] | None = None,
             masks: list[ColumnMask] | None = None) -> DataFrame:
    """Rows filtered and columns masked for one principal; schema unchanged.
    The filter runs on the real values before masking."""
    return mask_columns(row_filter(df, principal, policies or []), principal, masks or [])
