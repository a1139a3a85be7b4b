"""Build job: stored raw tables -> stored star schema, and its readers.

Staging and the union layer stay lazy plans (views); dimensions are tables;
the fact is an incremental table partitioned by order date, all of them snapshot
tables; the sales summary is a view over them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import quality as Q
from ordermill.plans import marts
from ordermill.plans import reports as R
from ordermill.plans.lineage import downstream, model_edges, raw_fingerprints
from ordermill.plans.model import Models, StoredRaw
from ordermill.schemas import RAW_TABLES
from ordermill.session import prepare
from ordermill.sources.files import materialize
from ordermill.sources.snapshots import SnapshotTable

LAYER = "reporting"
DIMENSIONS = ("dim_customer", "dim_product", "dim_campaign")
STORED = (*DIMENSIONS, "dim_date", "fact_orders")            # dim_date is a fixed span: it reads no raw table
INPUTS = "build_inputs"                                      # the raw tables as the last build found them

# report -> (function of the fact and the named dimensions, those dimensions)
REPORTS = {
    "rpt_sales_summary": (R.sales_summary, ("dim_product",)),
    "revenue_by_category_90d": (R.revenue_by_category_recent, ("dim_product",)),
    "top_customers": (R.top_customers, ("dim_customer",)),
    "campaign_effectiveness": (R.campaign_effectiveness, ("dim_campaign",)),
    "return_rate_by_region": (R.return_rate_by_region, ()),
    "source_volume": (R.source_volume, ()),
    "kpi_scorecard": (R.kpi_scorecard, ("dim_product",)),
    "revenue_over_time": (R.revenue_over_time, ()),
    "orders_by_category": (R.orders_by_category, ("dim_product",)),
    "revenue_by_category": (R.revenue_by_category, ("dim_product",)),
}


def build(spark: SparkSession, raw_root: str, model_root: str, full_refresh: bool = False) -> dict:
    """Store the star schema of the raw tables.  The first run (or a full
    refresh) stores every order; later runs read the stored fact's high-water
    mark once and shuffle only orders loaded after it.  Models whose raw tables
    have not changed since the last build stay as they are."""
    prepare(spark)
    model = Models(StoredRaw(spark, raw_root))
    inputs = raw_fingerprints(spark, raw_root)               # before the models read them
    stale = set(stale_models(spark, raw_root, model_root, inputs)) | (set(STORED) if full_refresh else set())
    for name in DIMENSIONS:
        if name in stale:
            _store(spark, model_root, name, getattr(model, name))
    if "dim_date" in stale:
        _store(spark, model_root, "dim_date", marts.dim_date(marts.date_spine(spark)))
    fact = SnapshotTable(spark, f"{model_root.rstrip('/')}/{LAYER}/fact_orders")
    stored = None if full_refresh or not fact.exists() else fact.read()
    if "fact_orders" not in stale:
        pass
    elif stored is None:
        _store(spark, model_root, "fact_orders", model.fact_orders, ["order_id"], ["order_date"])
    else:
        mark = stored.agg(F.unix_micros(F.max("loaded_at"))).first()[0]
        new = marts.new_fact_rows(model.stg_orders_batch, model.stg_orders_stream,
                                  F.timestamp_micros(F.lit(mark).cast("bigint")))
        fact.upsert(new)
    _store(spark, model_root, INPUTS, spark.createDataFrame(sorted(inputs.items()), "name string, fingerprint string"))
    built = Built(spark, model_root)
    built.register_views()
    return {"run": "full" if stored is None else "incremental"} | {
        r["table_name"]: r["row_count"] for r in built.row_counts().collect()}


def stale_models(spark: SparkSession, raw_root: str, model_root: str, inputs: dict | None = None) -> list[str]:
    """Stored models that are missing, or read a raw table that changed since
    the last build; inputs before their readers."""
    inputs = raw_fingerprints(spark, raw_root) if inputs is None else inputs
    root = f"{model_root.rstrip('/')}/{LAYER}"
    last = SnapshotTable(spark, f"{root}/{INPUTS}")
    before = {r["name"]: r["fingerprint"] for r in last.read().collect()} if last.exists() else {}
    changed = {name for name, now in inputs.items() if before.get(name) != now}
    reached = [m for m in downstream(model_edges(StoredRaw(spark, raw_root)), changed) if m in STORED and m != "dim_date"]
    missing = [m for m in STORED if m not in reached and not SnapshotTable(spark, f"{root}/{m}").exists()]
    return reached + missing


def _store(spark: SparkSession, model_root: str, name: str, df: DataFrame, keys=(), partition_by=()) -> None:
    """Replace a stored model by a new version of it; a reader sees the old or the new one."""
    table = SnapshotTable(spark, f"{model_root.rstrip('/')}/{LAYER}/{name}")
    table.create(df.schema, keys, partition_by)
    table.overwrite(df, df.schema)


class Built:
    """The stored star schema: tables, reports, quality suite."""

    def __init__(self, spark: SparkSession, model_root: str):
        self.spark = prepare(spark)
        self.root = f"{model_root.rstrip('/')}/{LAYER}"

    def _read(self, name: str) -> DataFrame:
        return SnapshotTable(self.spark, f"{self.root}/{name}").read()

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {n: self._read(n) for n in ("fact_orders", *DIMENSIONS, "dim_date")}

    def report(self, name: str, **kw) -> DataFrame:
        fn, dims = REPORTS[name]
        return fn(self.tables["fact_orders"], *[self.tables[d] for d in dims], **kw)

    def quality(self) -> DataFrame:
        return Q.run_suite(self.tables)

    def repeated_orders(self, since: int) -> DataFrame:
        """Order ids the fact holds more than once that came (again) after its version
        ``since``: the uniqueness check of a load, by its new keys only."""
        return SnapshotTable(self.spark, f"{self.root}/fact_orders").duplicates_since(since)

    def row_counts(self) -> DataFrame:
        return Q.row_counts(self.tables)

    def register_views(self) -> None:
        """The stored tables and the sales summary as views of the session."""
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)
        materialize(self.report("rpt_sales_summary"), "view", "rpt_sales_summary")


def raw_row_counts(spark: SparkSession, raw_root: str) -> DataFrame:
    raw = StoredRaw(spark, raw_root)
    return Q.row_counts({name: raw[name] for name in RAW_TABLES})
