"""Duplicate handling: one keep-one-per-key operator with the policy as an
argument, plus the duplicate report and the reconciliation of a sink.

Keep-one-per-key is a row_number() = 1 filter; Spark plans it with a
WindowGroupLimit on both sides of the shuffle, so a hot key is cut down to
one row per map task before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordering(order, keep: str) -> list[Column]:
    cols = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        cols.append(c.asc_nulls_last() if keep == "first" else c.desc_nulls_last())
    return cols


def dedup(df: DataFrame, keys: list[str], order: list, keep: str = "first",
          tie_break: list | None = None) -> DataFrame:
    """Keep one row per key: the first (smallest) or last (largest) by
    ``order``; ``tie_break`` columns (ascending) make the choice total.

    Policies: batch file = last by file position; stream = first by
    ingestion time; union layer = last by loaded_at; reconciliation = first
    by ingestion time.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    ordering = _ordering(order, keep) + [
        (F.col(t) if isinstance(t, str) else t).asc_nulls_last() for t in (tie_break or [])]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, with the count (HAVING count(*) > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def duplicate_copies(df: DataFrame, key: str = "order_id",
                     fields=("ingestion_timestamp", "event_timestamp")) -> DataFrame:
    """Read-only check: every copy of a key that has more than one, with the
    key's copy count, in (key, ingestion time) order.

    This is the long form of ARRAY_AGG(STRUCT(...) ORDER BY ts): one row per
    copy instead of one array per key, so a key holding a large share of
    all rows is never gathered into one task.  Counts come from a partial
    (map-side) aggregate; the final order is a range-partitioned sort, which
    splits a hot key across tasks.
    """
    dups = duplicate_keys(df, [key]).select(key, F.col("cnt").alias("copies"))
    rows = df.select(key, *fields).join(dups, key)
    return rows.select(key, "copies", *fields).orderBy(key, *fields)


def reconcile(df: DataFrame, keys=("order_id",), order=("ingestion_timestamp",),
              tie_break=None) -> DataFrame:
    """Sink reconciliation: keep the earliest-seen copy per key.  Copies with
    the same timestamp keep exactly one (the tie-break decides)."""
    tb = list(tie_break) if tie_break is not None else [c for c in df.columns
                                                      if c not in keys and c not in order]
    return dedup(df, list(keys), list(order), keep="first", tie_break=tb)
