"""The model graph from the code, and builds of what changed only."""

import pytest

from ordermill.plans.batch_job import create_raw, ingest_orders, ingest_reference
from ordermill.plans.build_job import LAYER, REPORTS, STORED, build, stale_models
from ordermill.plans.lineage import downstream, model_edges
from ordermill.plans.model import StoredRaw
from ordermill.schemas import ORDER_COLUMNS
from ordermill.sources.snapshots import SnapshotTable
from tests.helpers import GOOD


def test_downstream_order_and_cycles():
    edges = [("b", "a"), ("c", "b"), ("c", "x"), ("d", "c"), ("y", "x")]
    assert downstream(edges, {"a"}) == ["b", "c", "d"] and downstream(edges, {"x"}) == ["c", "y", "d"]
    assert downstream(edges, {"d"}) == []
    with pytest.raises(ValueError):
        downstream([("a", "r"), ("a", "b"), ("b", "a")], {"r"})


def test_only_models_of_changed_tables_are_built(spark, tmp):
    raw, models = f"{tmp}/raw", f"{tmp}/models"
    create_raw(spark, raw)
    edges = model_edges(StoredRaw(spark, raw), REPORTS)
    assert {("raw_products", "products"), ("stg_products", "raw_products"), ("dim_product", "stg_products"),
            ("int_orders_unioned", "stg_orders_batch"), ("fact_orders", "int_orders_unioned"), ("dim_date", "orders_stream"),
            ("rpt_sales_summary", "dim_product"), ("rpt_sales_summary", "fact_orders")} <= set(edges)
    assert ("fact_orders", "stg_orders_batch") not in edges
    assert "dim_product" in downstream(edges, {"products"}) and "fact_orders" not in downstream(edges, {"products"})

    def load(name, columns, *rows):
        with open(f"{tmp}/{name}", "w") as f:
            f.write("\n".join([",".join(columns), *[",".join(r) for r in rows]]) + "\n")
        return f"{tmp}/{name}"
    campaigns = ["campaign_id", "campaign_name", "expected_performance"]
    ingest_reference(spark, "campaigns", load("c.csv", campaigns, ["4", "Four", "High"]), raw)
    ingest_orders(spark, load("o.csv", ORDER_COLUMNS, [GOOD[c] for c in ORDER_COLUMNS]), raw)
    versions = lambda: {m: SnapshotTable(spark, f"{models}/{LAYER}/{m}").versions()[-1] for m in STORED}
    assert sorted(stale_models(spark, raw, models)) == sorted(STORED)
    build(spark, raw, models)
    first = versions()
    assert stale_models(spark, raw, models) == []
    build(spark, raw, models)
    assert versions() == first
    ingest_reference(spark, "campaigns", load("c2.csv", campaigns, ["4", "Four", "Low"], ["5", "Five", "Low"]), raw)
    assert stale_models(spark, raw, models) == ["dim_campaign"]
    build(spark, raw, models)
    assert versions() == first | {"dim_campaign": first["dim_campaign"] + 1}
    ingest_orders(spark, load("o2.csv", ORDER_COLUMNS, [dict(GOOD, order_id="Z")[c] for c in ORDER_COLUMNS]), raw)
    out = build(spark, raw, models)
    assert (out["run"], out["fact_orders"], out["dim_campaign"]) == ("incremental", 2, 2)
    assert versions()["fact_orders"] == first["fact_orders"] + 1 and versions()["dim_product"] == first["dim_product"]
