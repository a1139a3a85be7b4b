"""The whole model graph over one set of raw tables, built lazily.

``Models(raw)`` exposes every layer over a lookup of raw tables as a
DataFrame attribute; each is a lazy plan, so Catalyst optimizes from the
parquet scans to the final report.  ``StoredRaw`` looks the raw tables up
under a raw root, ``StandInRaw`` derives them from a folder of test tables;
``Model(spark, sf_dir)`` is the latter with the stand-in runs beside it.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import validate as V
from ordermill.plans import marts, staging
from ordermill.schemas import RAW_TABLES
from ordermill.session import prepare
from ordermill.sources import testdata as td
from ordermill.sources.files import read_declared
from ordermill.sources.messages import decode_orders

# Run parameters of the test-table model.
AS_OF = _dt.date(2001, 8, 1)                      # stands in for CURRENT_DATE
FIRST_LOAD_CUTOFF = _dt.datetime(1998, 1, 1)      # rows loaded before it form the first run
EVENTS_FIRST_RUN = _dt.datetime(2024, 1, 16)      # events before it were validated in run 1
BATCH_RUN_CLOCK = _dt.datetime(2024, 2, 1)        # clock of the batch validation run
FIRST_RUN_CLOCK = _dt.datetime(2024, 1, 16)       # clock of the first error load
WINDOW_S, LATENESS_S = 60, 300                    # stream window and allowed lateness
DEDUP_WINDOW_S = 3600                             # window of the stream dedup stand-in


def ts_lit(v: _dt.datetime):
    return F.lit(v).cast("timestamp")


class StandInRaw:
    """Raw tables derived from a folder of test tables."""

    def __init__(self, tables: td.Tables):
        self.t = tables

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(td, f"raw_{name}")(self.t)

    def order_dates(self) -> DataFrame:
        return self.t["orders"].select(F.col("o_orderdate").cast("date").alias("order_date"))


class StoredRaw:
    """Raw tables that the ingest jobs keep under a raw root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return read_declared(self.spark, f"{self.root}/{name}", RAW_TABLES[name][0])

    def order_dates(self) -> DataFrame:
        return self["orders_batch"].select("order_date").unionByName(
            self["orders_stream"].select("order_date"))


class Models:
    def __init__(self, raw):
        self.raw = raw

    # raw layer ---------------------------------------------------------
    @cached_property
    def raw_orders_batch(self) -> DataFrame:
        return self.raw["orders_batch"]

    @cached_property
    def raw_orders_stream(self) -> DataFrame:
        return self.raw["orders_stream"]

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self.raw["customers"]

    @cached_property
    def raw_products(self) -> DataFrame:
        return self.raw["products"]

    @cached_property
    def raw_campaigns(self) -> DataFrame:
        return self.raw["campaigns"]

    # staging / intermediate / marts -----------------------------------------
    @cached_property
    def stg_orders_batch(self):
        return staging.stg_orders_batch(self.raw_orders_batch)

    @cached_property
    def stg_orders_stream(self):
        return staging.stg_orders_stream(self.raw_orders_stream)

    @cached_property
    def stg_customers(self):
        return staging.stg_customers(self.raw_customers)

    @cached_property
    def stg_products(self):
        return staging.stg_products(self.raw_products)

    @cached_property
    def stg_campaigns(self):
        return staging.stg_campaigns(self.raw_campaigns)

    @cached_property
    def int_orders_unioned(self):
        return marts.int_orders_unioned(self.stg_orders_batch, self.stg_orders_stream)

    @cached_property
    def dim_customer(self):
        return marts.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self):
        return marts.dim_product(self.stg_products)

    @cached_property
    def dim_campaign(self):
        return marts.dim_campaign(self.stg_campaigns)

    @cached_property
    def dim_date(self):
        return marts.dim_date(marts.date_spine_between(self.raw.order_dates(), "order_date"))

    @cached_property
    def fact_orders(self):
        return marts.fact_orders(self.int_orders_unioned)

    # SQL access -----------------------------------------------------------------
    VIEW_LAYERS = ("raw_orders_batch", "raw_orders_stream", "raw_customers", "raw_products",
                   "raw_campaigns", "stg_orders_batch", "stg_orders_stream", "stg_customers",
                   "stg_products", "stg_campaigns", "int_orders_unioned", "dim_customer",
                   "dim_product", "dim_campaign", "dim_date", "fact_orders")

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every layer as a temp view (lazy: a view is the plan, not a
        copy), so reports can also be written as Spark SQL."""
        names = []
        for layer in self.VIEW_LAYERS:
            name = prefix + layer
            getattr(self, layer).createOrReplaceTempView(name)
            names.append(name)
        return names


class Model(Models):
    """The model graph over a folder of test tables, and the stand-in runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = td.Tables(spark, sf_dir)
        super().__init__(StandInRaw(self.t))

    @cached_property
    def fact_orders_first_run(self):
        """The fact as the first run built it: only rows loaded before the cutoff."""
        cut = ts_lit(FIRST_LOAD_CUTOFF)
        b = staging.stg_orders_batch(self.raw_orders_batch.where(F.col("ingestion_timestamp") < cut))
        s = staging.stg_orders_stream(self.raw_orders_stream.where(F.col("ingestion_timestamp") < cut))
        return marts.fact_orders(marts.int_orders_unioned(b, s))

    @cached_property
    def fact_orders_incremental(self):
        return marts.incremental_fact(self.stg_orders_batch, self.stg_orders_stream,
                                      existing=self.fact_orders_first_run)

    # validation inputs -----------------------------------------------------------
    @cached_property
    def order_text_rows(self):
        return td.order_text_rows(self.t)

    def validated_batch(self, rows: DataFrame | None = None) -> DataFrame:
        return V.validate_orders(self.order_text_rows if rows is None else rows, "batch")

    @cached_property
    def validated_stream(self):
        return self.validated_messages(td.order_messages(self.t))

    def validated_messages(self, messages: DataFrame) -> DataFrame:
        return V.validate_orders(decode_orders(messages), "stream", raw=F.col("value"), arrival_ts=F.col("arrival_ts"),
                                 window_s=WINDOW_S, lateness_s=LATENESS_S)

    @cached_property
    def batch_errors(self):
        return V.error_rows(self.validated_batch(), "batch", ts_lit(BATCH_RUN_CLOCK))

    @cached_property
    def stream_errors(self):
        return V.error_rows(self.validated_stream, "stream", F.col("arrival_ts"))

    @cached_property
    def stream_good(self):
        """Good stream rows with their window and ingestion (arrival) time."""
        g = self.validated_stream.where(F.col("error_reason").isNull())
        return g.withColumn("ingestion_timestamp", F.col("arrival_ts"))
