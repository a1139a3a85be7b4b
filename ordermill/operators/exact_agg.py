"""Grouping with exact sums of doubles (see functions.exact).

One pass over the rows: each row sends one record per double measure (its
exponent bin and parts) and one for the counted id, so that the first grouping
(group, id, measure, bin) is a plain sum with map-side partials, and a hot
group or id costs a record per task.  The second grouping meets a record per
bin and distinct id of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions import exact


def exact_group(df: DataFrame, keys: list[str], doubles: tuple = (), distinct: str | None = None,
                whole: tuple = ()) -> DataFrame:
    """One row per group with ``keys``, ``rows`` (their number), ``ids`` (distinct
    non-null values of ``distinct``), for each double measure its bins, and for
    each whole one a struct of its exact sum ``s`` and non-null count ``n``.
    Without keys: one row, also for no rows."""
    rows = df.select(*keys, *([F.col(distinct).alias("_id")] if distinct else []),
                     *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(doubles)],
                     *[F.col(c).alias(f"_w{i}") for i, c in enumerate(whole)])
    rows = rows.selectExpr("*", *[f"{exact.exponent_bin(f'_x{i}')} AS _b{i}" for i in range(len(doubles))])
    rows = rows.selectExpr("*", *[f"{exact.scaled(f'_x{i}', f'_b{i}')} AS _y{i}" for i in range(len(doubles))])
    rows = rows.selectExpr("*", *[f"_y{i} - floor(_y{i}) AS _r{i}" for i in range(len(doubles))])
    types = dict(rows.dtypes)

    def record(measure: int | None, counted: bool, first: bool) -> str:
        values = exact.parts(f"_y{measure}", f"_r{measure}") if measure is not None else ["CAST(NULL AS BIGINT)"] * 4
        fields = {"m": f"CAST({'NULL' if measure is None else measure} AS INT)",
                  "b": "CAST(NULL AS INT)" if measure is None else f"_b{measure}"}
        fields |= dict(zip(exact.PARTS, values))
        if distinct:
            fields["id"] = "_id" if counted else f"CAST(NULL AS {types['_id']})"
        fields["rows"] = f"{int(first)}L"
        fields |= {f"w{i}": f"_w{i}" if first else f"CAST(NULL AS {types[f'_w{i}']})" for i in range(len(whole))}
        return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in fields.items())})"

    # the counted id travels alone, so that bins are not split by it
    records = [record(i, False, i == 0) for i in range(len(doubles))] or [record(None, False, True)]
    if distinct:
        records.append(record(None, True, False))
    r = rows.select(*keys, F.expr(f"explode(array({', '.join(records)}))").alias("r")).select(*keys, "r.*")
    by = [*keys, *(["id"] if distinct else []), "m", "b"]
    first = r.groupBy(*by).agg(
        *[F.sum(p).alias(p) for p in exact.PARTS], F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"),
        *[a for i in range(len(whole)) for a in (F.sum(F.col(f"w{i}").cast("decimal(38,0)")).alias(f"s{i}"),
                                                 F.count(f"w{i}").alias(f"n{i}"))])
    one_bin = F.struct("m", "b", *exact.PARTS, "n")
    second = first.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("b").isNotNull(), one_bin)).alias("_bins"),     # at most 100 a measure
        *([F.count("id").alias("ids")] if distinct else []),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.struct(F.sum(f"s{i}").alias("s"), F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias("n")).alias(c)
          for i, c in enumerate(whole)])
    bins = [F.expr(f"filter(_bins, e -> e.m = {i})").alias(c) for i, c in enumerate(doubles)]
    return second.select(*keys, *(["ids"] if distinct else []), "rows", *bins, *whole)
