"""Data-quality checks as DataFrames of failures, and a suite runner that
returns one (table, column, check, failures) row per declared check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The declared checks of the star schema (table, column, check, target).
STAR_SCHEMA_CHECKS = [
    ("fact_orders", "order_id", "not_null", None),
    ("fact_orders", "order_id", "unique", None),
    ("fact_orders", "customer_key", "not_null", None),
    ("fact_orders", "customer_key", "relationships", ("dim_customer", "customer_key")),
    ("fact_orders", "product_key", "not_null", None),
    ("fact_orders", "product_key", "relationships", ("dim_product", "product_key")),
    ("fact_orders", "campaign_key", "relationships", ("dim_campaign", "campaign_key")),
    ("fact_orders", "revenue", "not_null", None),
    ("dim_customer", "customer_key", "not_null", None),
    ("dim_customer", "customer_key", "unique", None),
    ("dim_product", "product_key", "not_null", None),
    ("dim_product", "product_key", "unique", None),
    ("dim_campaign", "campaign_key", "not_null", None),
    ("dim_campaign", "campaign_key", "unique", None),
    ("dim_date", "date_key", "not_null", None),
    ("dim_date", "date_key", "unique", None),
]


def unique_failures(df: DataFrame, cols) -> DataFrame:
    """Keys (non-null) that occur more than once, with their count.

    Keys with a null are counted as 0 instead of being filtered first: a filter would sink
    below the dedup of its table, whose exchange the other checks could then not share."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    whole = F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), 1)
    return df.groupBy(*cols).agg(F.count(whole).alias("cnt")).where("cnt > 1")


def relationship_failures(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (orphans)."""
    keys = parent.select(F.col(parent_col).alias(col)).distinct()
    return df.where(F.col(col).isNotNull()).join(keys, col, "left_anti")


def _count(df: DataFrame, table: str, col: str, check: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
        F.lit(check).alias("test"), "failures")


def _not_null_counts(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """All not-null checks of one table in a single aggregate pass, unpivoted
    to one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot([], cols, "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.lit("not_null").alias("test"), "failures")


def _relationship_counts(df: DataFrame, table: str, rels: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """All relationship checks of one table in a single pass: the child is
    left-joined to each parent's distinct keys (one row per key, so no row
    is multiplied; bounded parents are broadcast) and orphans are counted
    in one aggregate."""
    from ordermill.operators.joins import star_join

    cols = []
    j = df.select(*{c for c, _, _ in rels})
    for i, (col, parent, parent_col) in enumerate(rels):
        flag = f"_has_parent_{i}"
        keys = parent.select(F.col(parent_col).alias(col)).distinct().withColumn(flag, F.lit(True))
        j = star_join(j, keys, col, "left")
        cols.append((col, F.count_if(F.col(col).isNotNull() & F.col(flag).isNull()).alias(col)))
    agg = j.agg(*[c for _, c in cols])
    names = [c for c, _ in cols]
    long = agg.unpivot([], names, "column_name", "failures")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.lit("relationships").alias("test"), "failures")


def run_suite(tables: dict[str, DataFrame], checks=STAR_SCHEMA_CHECKS) -> DataFrame:
    """All checks as one plan: per table one pass for every not-null check,
    one pass for every relationship check, one grouped pass per unique key."""
    parts = []
    not_null: dict[str, list[str]] = {}
    rels: dict[str, list] = {}
    for table, col, check, target in checks:
        if check == "not_null":
            not_null.setdefault(table, []).append(col)
        elif check == "relationships":
            rels.setdefault(table, []).append((col, tables[target[0]], target[1]))
        elif check != "unique":
            raise ValueError(f"unknown check {check}")
    for table, cols in not_null.items():
        parts.append(_not_null_counts(tables[table], table, cols))
    for table, rs in rels.items():
        parts.append(_relationship_counts(tables[table], table, rs))
    for table, col, check, target in checks:
        if check == "unique":
            parts.append(_count(unique_failures(tables[table], col), table, col, check))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table, one plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
