"""Hand-made order rows for the operator tests."""

from ordermill.schemas import ORDER_COLUMNS, all_strings

GOOD = {
    "order_id": "A1", "customer_id": "632", "product_id": "238", "region_id": "26",
    "campaign_id": "", "order_date": "2026-05-30", "quantity": "1", "unit_price": "4837.64",
    "discount": "21.17", "shipping_cost": "54.45", "payment_method": "Net Banking",
    "delivery_days": "7", "returned_flag": "0", "order_status": "Delivered",
    "warehouse_region": "West Hub", "customer_rating": "2", "customer_city": "Pune",
    "customer_state": "Maharashtra",
}


def row(**over):
    r = dict(GOOD)
    r.update(over)
    return tuple(r[c] if r[c] != "" else None for c in ORDER_COLUMNS)


def text_df(spark, rows, extra_cols=()):
    schema = all_strings(ORDER_COLUMNS)
    for c in extra_cols:
        schema = schema.add(c, "string")
    return spark.createDataFrame(rows, schema)
