"""Every registered SQL view shows the rows of its model layer."""

import pytest

from ordermill.plans.model import Model
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("layer", ["stg_customers", "dim_product", "dim_campaign", "int_orders_unioned", "fact_orders"])
def test_view_is_its_layer(spark, layer):
    model = Model(spark, SF_SMALL)
    model.register_views()
    frame = getattr(model, layer)
    view = spark.table(layer)
    assert view.columns == frame.columns
    assert view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty()
