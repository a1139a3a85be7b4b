"""Every registered query against its DuckDB SQL on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from ordermill.plans.registry import QUERIES
from ordermill.sources.testdata import TABLE_NAMES
from tests.conftest import SF_SMALL
from tools.check_oracle import canon


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
         "timestamp": "TIMESTAMP", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    assert spark_types == {c: str(t) for c, t in zip(cols, rel.types)}
    assert canon(df.columns, rows) == canon(cols, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "warehouse_region", "total_orders", "total_revenue",
                          "avg_order_value", "return_rate_pct", "avg_delivery_days"]
