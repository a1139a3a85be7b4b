"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each reads the test tables (or what Spark derives from them) in full; the
matching DuckDB SQL lives in ``oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ordermill.operators import governance as G
from ordermill.operators import quality as Q
from ordermill.operators import validate as V
from ordermill.operators.dedup import dedup, duplicate_copies, duplicate_keys, reconcile
from ordermill.operators.upsert import insert_only, upsert
from ordermill.plans import marts
from ordermill.plans.build_job import REPORTS
from ordermill.plans.model import (AS_OF, BATCH_RUN_CLOCK, DEDUP_WINDOW_S, EVENTS_FIRST_RUN,
                                   FIRST_LOAD_CUTOFF, FIRST_RUN_CLOCK, Model, ts_lit)
from ordermill.plans.replay import error_order_ids, pending_rows
from ordermill.schemas import PRODUCTS, coercion_spec
from ordermill.sources import faults
from ordermill.sources import testdata as td

# Principals and policies of the governed views.
ANALYST = "analyst@example.com"
FINANCE = "finance@example.com"
REGION_POLICY = G.RowPolicy("america_only", frozenset({ANALYST}), "warehouse_region = 'AMERICA'")
MONEY_MASK = G.ColumnMask(("revenue", "unit_price"), frozenset({FINANCE}))


def _m(spark, sf_dir) -> Model:
    """A new model graph per query: nothing is kept that could go stale."""
    return Model(spark, sf_dir)


def q_table_counts(spark, d):
    m = _m(spark, d)
    return Q.row_counts({
        "orders_batch": m.raw_orders_batch, "orders_stream": m.raw_orders_stream,
        "orders_batch_errors": m.batch_errors, "orders_stream_errors": m.stream_errors,
        "customers": m.raw_customers, "products": m.raw_products, "campaigns": m.raw_campaigns,
        "int_orders_unioned": m.int_orders_unioned, "fact_orders": m.fact_orders})


def q_quality_suite(spark, d):
    m = _m(spark, d)
    return Q.run_suite({"fact_orders": m.fact_orders, "dim_customer": m.dim_customer,
                        "dim_product": m.dim_product, "dim_campaign": m.dim_campaign,
                        "dim_date": m.dim_date})


def q_validate_good(spark, d):
    return V.good_rows(_m(spark, d).validated_batch(), "batch", ts_lit(BATCH_RUN_CLOCK))


def q_validate_bad(spark, d):
    return _m(spark, d).batch_errors


def q_validation_counts(spark, d):
    return V.validation_counts(_m(spark, d).validated_batch())


def q_dedup_last_wins(spark, d):
    """Batch file policy: the last good row (file position) per order_id."""
    v = _m(spark, d).validated_batch().where(F.col("error_reason").isNull())
    last = dedup(v, ["order_id"], ["_pos"], keep="last")
    return V.good_rows(last, "batch", ts_lit(BATCH_RUN_CLOCK))


def q_dedup_first_in_window(spark, d):
    """Stream policy: per (event-time window, order_id), the copy ingested first."""
    g = _m(spark, d).stream_good.withColumn(
        "window", F.window("event_timestamp", f"{DEDUP_WINDOW_S} seconds"))
    first = dedup(g, ["window", "order_id"], ["ingestion_timestamp"], keep="first",
                  tie_break=["_pos"])
    return first.select("order_id", F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), "event_timestamp",
                        "ingestion_timestamp", "customer_id", "quantity", "unit_price")


def q_late_events(spark, d):
    v = _m(spark, d).validated_stream
    late = v.where(F.col("error_reason").startswith("event arrived too late"))
    return late.select("order_id", "event_timestamp", F.col("arrival_ts"),
                       ((F.unix_micros("arrival_ts") - F.unix_micros("event_timestamp"))
                        / 1_000_000).cast("bigint").alias("lateness_seconds"),
                       "error_reason")


def q_upsert_orders(spark, d):
    m = _m(spark, d)
    cut = ts_lit(FIRST_LOAD_CUTOFF)
    raw = m.raw_orders_batch
    latest = lambda df: dedup(df, ["order_id"], ["ingestion_timestamp"], keep="last")
    target = latest(raw.where(F.col("ingestion_timestamp") < cut))
    source = latest(raw.where(F.col("ingestion_timestamp") >= cut))
    return upsert(target, source, ["order_id"])


def q_insert_only_errors(spark, d):
    m = _m(spark, d)
    rows = m.order_text_rows
    first = V.error_rows(m.validated_batch(rows.where(F.col("_event_ts") < ts_lit(EVENTS_FIRST_RUN))),
                         "batch", ts_lit(FIRST_RUN_CLOCK))
    rerun = V.error_rows(m.validated_batch(rows), "batch", ts_lit(BATCH_RUN_CLOCK))
    return insert_only(first, rerun, ["error_id"])


def q_reconcile_stream(spark, d):
    return reconcile(_m(spark, d).raw_orders_stream)


def q_duplicate_copies(spark, d):
    return duplicate_copies(_m(spark, d).raw_orders_stream)


def q_duplicate_order_ids(spark, d):
    return duplicate_keys(_m(spark, d).int_orders_unioned, ["order_id"])


def q_error_order_ids(spark, d):
    return error_order_ids(_m(spark, d).stream_errors)


def q_replay_pending_ids(spark, d):
    m = _m(spark, d)
    landed = m.raw_orders_stream.where(F.col("ingestion_timestamp") < ts_lit(FIRST_LOAD_CUTOFF))
    return pending_rows(m.raw_orders_stream, landed, m.stream_errors).select(
        "order_id", "ingestion_timestamp")


def q_coerce_dimension(spark, d):
    return V.coerce_dimension(td.product_text_rows(td.Tables(spark, d)), coercion_spec(PRODUCTS))


# over the stand-ins with planted faults

def q_validate_faults(spark, d):
    """Error rows of every kind; text cut as the stream's error table has it."""
    m = _m(spark, d)
    return V.error_rows(m.validated_batch(faults.order_text_rows(m.t)), "stream", ts_lit(BATCH_RUN_CLOCK))


def q_validate_odd_good(spark, d):
    m = _m(spark, d)
    return V.good_rows(m.validated_batch(faults.order_text_rows(m.t)), "batch", ts_lit(BATCH_RUN_CLOCK))


def q_duplicate_raw_order_ids(spark, d):
    return duplicate_keys(_m(spark, d).order_text_rows, ["order_id"])


def q_replay_pending_events(spark, d):
    """Events to send again: neither landed in the first run nor rejected."""
    m = _m(spark, d)
    rows, messages = faults.many_order_messages(m.t)
    checked = m.validated_messages(messages)
    landed = checked.where(F.col("error_reason").isNull() & (F.col("event_timestamp") < ts_lit(EVENTS_FIRST_RUN)))
    errors = V.error_rows(checked, "stream", F.col("arrival_ts"))
    return pending_rows(rows, landed, errors).select("order_id", "customer_id", "_event_ts")


def q_fact_wide_discounts(spark, d):
    return marts.fact_rows(faults.wide_discounts(_m(spark, d).int_orders_unioned))


def q_campaigns_wide_discounts(spark, d):
    m = _m(spark, d)
    fact = marts.fact_rows(faults.wide_discounts(m.int_orders_unioned))
    return REPORTS["campaign_effectiveness"][0](fact, m.dim_campaign)


def _odd_prices(name):
    """A report over orders with huge, NaN and infinite prices."""
    fn, dims = REPORTS[name]

    def run(spark, d):
        m = _m(spark, d)
        return fn(marts.fact_rows(faults.odd_prices(m.int_orders_unioned)), *[getattr(m, x) for x in dims])
    return run


def q_coerce_wide_keys(spark, d):
    return V.coerce_dimension(faults.wide_product_text_rows(td.Tables(spark, d)), coercion_spec(PRODUCTS))


def q_quality_suite_faults(spark, d):
    return Q.run_suite(faults.broken_star(_m(spark, d)))


def _governed(spark, d, policies, masks):
    return G.governed(_m(spark, d).fact_orders, ANALYST, policies, masks)


def q_row_policy_view(spark, d):
    return _governed(spark, d, [REGION_POLICY], [])


def q_masked_view(spark, d):
    return _governed(spark, d, [], [MONEY_MASK])


def q_row_and_mask_view(spark, d):
    return _governed(spark, d, [REGION_POLICY], [MONEY_MASK])


def _layer(name):
    return lambda spark, d: getattr(_m(spark, d), name)


def _report(name, **kw):
    fn, dims = REPORTS[name]

    def run(spark, d):
        m = _m(spark, d)
        return fn(m.fact_orders, *[getattr(m, x) for x in dims], **kw)
    return run


QUERIES = {
    "stg_orders_batch": _layer("stg_orders_batch"),
    "stg_orders_stream": _layer("stg_orders_stream"),
    "stg_customers": _layer("stg_customers"),
    "stg_products": _layer("stg_products"),
    "stg_campaigns": _layer("stg_campaigns"),
    "int_orders_unioned": _layer("int_orders_unioned"),
    "dim_customer": _layer("dim_customer"),
    "dim_product": _layer("dim_product"),
    "dim_campaign": _layer("dim_campaign"),
    "dim_date": _layer("dim_date"),
    "fact_orders": _layer("fact_orders"),
    "fact_orders_incremental": _layer("fact_orders_incremental"),
    **{name: _report(name) for name in REPORTS},
    "revenue_by_category_90d": _report("revenue_by_category_90d", as_of=AS_OF),
    "table_counts": q_table_counts,
    "duplicate_order_ids": q_duplicate_order_ids,
    "duplicate_copies": q_duplicate_copies,
    "reconcile_stream": q_reconcile_stream,
    "validate_good": q_validate_good,
    "validate_bad": q_validate_bad,
    "validation_counts": q_validation_counts,
    "dedup_last_wins": q_dedup_last_wins,
    "dedup_first_in_window": q_dedup_first_in_window,
    "late_events": q_late_events,
    "upsert_orders": q_upsert_orders,
    "insert_only_errors": q_insert_only_errors,
    "replay_pending_ids": q_replay_pending_ids,
    "error_order_ids": q_error_order_ids,
    "row_policy_view": q_row_policy_view,
    "masked_view": q_masked_view,
    "row_and_mask_view": q_row_and_mask_view,
    "coerce_dimension": q_coerce_dimension,
    "quality_suite": q_quality_suite,
    "validate_faults": q_validate_faults,
    "validate_odd_good": q_validate_odd_good,
    "duplicate_raw_order_ids": q_duplicate_raw_order_ids,
    "replay_pending_events": q_replay_pending_events,
    "fact_wide_discounts": q_fact_wide_discounts,
    "campaigns_wide_discounts": q_campaigns_wide_discounts,
    "sales_summary_odd_prices": _odd_prices("rpt_sales_summary"),
    "revenue_over_time_odd_prices": _odd_prices("revenue_over_time"),
    "coerce_wide_keys": q_coerce_wide_keys,
    "quality_suite_faults": q_quality_suite_faults,
}
