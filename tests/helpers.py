"""Hand-made stars of a few rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from tillscope.operators.calendar import calendar
from tillscope.sources.schema import TABLES
from tillscope.star import Star

D = date.fromisoformat

PRODUCT = {"product_id": 1, "sku": "P1", "product_name": "Milk", "brand": "B", "category": "Dairy",
           "subcategory": "Fresh", "list_price": 10, "is_active": True}
STORE = {"store_id": 1, "store_code": "T1", "store_name": "One", "chain": "C", "format": "Super", "region": "North",
         "city": "X", "floor_area_m2": 100, "is_active": True}
SALE = {"sale_id": 1, "product_id": 1, "store_id": 1, "sale_date": D("2024-06-05"), "sale_time": "10:00:00",
        "ticket_id": "t1", "quantity": 1, "unit_price": 10, "discount_pct": 0, "tax_pct": 16, "channel": "in-store"}
SNAPSHOT = {"inventory_id": 1, "product_id": 1, "store_id": 1, "snapshot_date": D("2024-06-01"), "opening_stock": 10,
            "final_stock": 10, "stock_in": 0, "stock_out": 0, "unit_cost": 4}


def frame(spark, table, base, rows):
    schema = TABLES[table]
    data = []
    for changes in rows:
        row = {**base, **changes}
        data.append(tuple(
            Decimal(str(row[f.name])) if isinstance(f.dataType, T.DecimalType) and row.get(f.name) is not None
            else row.get(f.name)
            for f in schema.fields
        ))
    return spark.createDataFrame(data, schema)


def products(*rows, base=PRODUCT):
    return [{**base, **r} for r in rows]


def star(spark, sales=(), inventory=(), products=({},), stores=({},), first="2024-01-01", last="2024-12-31"):
    return Star(
        products=frame(spark, "products", PRODUCT, products),
        stores=frame(spark, "stores", STORE, stores),
        calendar=calendar(spark, D(first), D(last)),
        sales=frame(spark, "sales", SALE, sales),
        inventory=frame(spark, "inventory", SNAPSHOT, inventory),
    )


def rows(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]
