"""Merges as DataFrame plans: upsert (update + insert), insert-only, and the
high-water-mark filter of an incremental model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE all columns WHEN NOT MATCHED INSERT.

    Target rows whose key is in the source are replaced by the source rows;
    the rest of the target stays.  The source keys are made distinct before
    the anti join so a hot key costs one build row.
    """
    src_keys = source.select(*keys).distinct()
    kept = target.join(src_keys, list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE ... WHEN NOT MATCHED INSERT: source rows with a new key are
    added; equal rows inside one load are all added (no source dedup)."""
    tgt_keys = target.select(*keys).distinct()
    new = source.join(tgt_keys, list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def high_water_mark(target: DataFrame, ts_col: str) -> Column:
    """Scalar subquery: max(ts_col) of the target (null when it is empty)."""
    return target.select(F.max(ts_col)).scalar()


def incremental_source(source: DataFrame, target: DataFrame | None, ts_col: str = "loaded_at") -> DataFrame:
    """Rows newer than the target's high-water mark.  No target: all rows
    (first run / full refresh); an empty target: no rows (max is null);
    ties with the mark are skipped (strict >)."""
    if target is None:
        return source
    return source.where(F.col(ts_col) > high_water_mark(target, ts_col))


def incremental_merge(source: DataFrame, target: DataFrame | None, keys: list[str],
                      ts_col: str = "loaded_at") -> DataFrame:
    """Incremental model run: merge the new rows into the target by key."""
    new = incremental_source(source, target, ts_col)
    return new if target is None else upsert(target, new, keys)
