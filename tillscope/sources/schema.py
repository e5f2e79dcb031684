"""Types, defaults, file formats and descriptions of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)
STOCK_VALUE = T.DecimalType(15, 2)


def _table(*columns: tuple) -> T.StructType:
    """StructType from (name, type, comment) entries."""
    return T.StructType(
        [T.StructField(name, kind, True, {"comment": note} if note else {}) for name, kind, note in columns]
    )


# Identifiers are BIGINT throughout, so generated keys never run out.
PRODUCTS = _table(
    ("product_id", T.LongType(), "Product key"),
    ("sku", T.StringType(), "Stock keeping unit, unique"),
    ("product_name", T.StringType(), "Commercial name"),
    ("brand", T.StringType(), "Brand"),
    ("category", T.StringType(), "Main category"),
    ("subcategory", T.StringType(), "Subcategory"),
    ("list_price", PRICE, "Suggested retail price"),
    ("is_active", T.BooleanType(), "Offered at present"),
    ("created_at", T.TimestampType(), "Row creation time"),
    ("updated_at", T.TimestampType(), "Last change"),
)
STORES = _table(
    ("store_id", T.LongType(), "Store key"),
    ("store_code", T.StringType(), "Business code, unique"),
    ("store_name", T.StringType(), "Store name"),
    ("chain", T.StringType(), "Chain the store belongs to"),
    ("format", T.StringType(), "Super, Express, Hiper or Convenience"),
    ("region", T.StringType(), "Sales region"),
    ("city", T.StringType(), "City"),
    ("state", T.StringType(), "State"),
    ("postal_code", T.StringType(), "Postal code"),
    ("floor_area_m2", T.IntegerType(), "Floor area in square metres"),
    ("opened_on", T.DateType(), "Opening date"),
    ("is_active", T.BooleanType(), "Open at present"),
    ("created_at", T.TimestampType(), "Row creation time"),
    ("updated_at", T.TimestampType(), "Last change"),
)
CALENDAR = _table(
    ("cal_date", T.DateType(), "Calendar day"),
    ("day", T.IntegerType(), "Day of month"),
    ("iso_weekday", T.IntegerType(), "1 Monday to 7 Sunday"),
    ("day_name", T.StringType(), "English day name, padded to 9"),
    ("iso_week", T.IntegerType(), "ISO week"),
    ("month", T.IntegerType(), "Month"),
    ("month_name", T.StringType(), "English month name, padded to 9"),
    ("quarter", T.IntegerType(), "Quarter"),
    ("year", T.IntegerType(), "Calendar year"),
    ("is_weekend", T.BooleanType(), "Saturday or Sunday"),
    ("is_holiday", T.BooleanType(), "Listed holiday"),
    ("holiday_name", T.StringType(), "Holiday name"),
    ("fiscal_period", T.StringType(), "Label such as Q1-2024"),
)
SALES = _table(
    ("sale_id", T.LongType(), "Line key, unique together with the date"),
    ("product_id", T.LongType(), "Product sold"),
    ("store_id", T.LongType(), "Selling store"),
    ("sale_date", T.DateType(), "Day of sale"),
    ("sale_time", T.StringType(), "Time of sale as HH:mm:ss"),
    ("ticket_id", T.StringType(), "Groups the lines of one transaction"),
    ("quantity", T.IntegerType(), "Units"),
    ("unit_price", PRICE, "Price per unit"),
    ("discount_pct", PERCENT, "Discount in percent"),
    ("tax_pct", PERCENT, "Tax in percent"),
    ("channel", T.StringType(), "in-store, online, mobile or phone"),
    ("seller_id", T.LongType(), "Seller"),
    ("created_at", T.TimestampType(), "Row creation time"),
)
INVENTORY = _table(
    ("inventory_id", T.LongType(), "Snapshot key"),
    ("product_id", T.LongType(), "Product"),
    ("store_id", T.LongType(), "Store"),
    ("snapshot_date", T.DateType(), "Day of snapshot"),
    ("opening_stock", T.IntegerType(), "Stock at the start of the period"),
    ("final_stock", T.IntegerType(), "Stock at its end"),
    ("stock_in", T.IntegerType(), "Units received"),
    ("stock_out", T.IntegerType(), "Units sent out"),
    ("unit_cost", PRICE, "Cost per unit"),
    ("stock_value", STOCK_VALUE, "Final stock times unit cost"),
    ("created_at", T.TimestampType(), "Row creation time"),
)
TABLES = {
    "products": PRODUCTS,
    "stores": STORES,
    "calendar": CALENDAR,
    "sales": SALES,
    "inventory": INVENTORY,
}
KEYS = {"products": "product_id", "stores": "store_id", "sales": "sale_id", "inventory": "inventory_id"}
DESCRIPTIONS = {
    "products": "Product dimension",
    "stores": "Store dimension: chain, format, store",
    "calendar": "Calendar dimension with holidays",
    "sales": "Sale lines, laid out by year",
    "inventory": "Stock snapshots per product, store and date",
}

# Defaults of columns a source leaves out, as SQL expressions. A column that is
# present keeps its NULLs.
DEFAULTS = {
    "products": {"is_active": "true", "created_at": "current_timestamp()", "updated_at": "current_timestamp()"},
    "stores": {"is_active": "true", "created_at": "current_timestamp()", "updated_at": "current_timestamp()"},
    "calendar": {"is_holiday": "false"},
    "sales": {
        "discount_pct": "0",
        "tax_pct": "16",
        "channel": "'in-store'",
        "created_at": "current_timestamp()",
    },
    "inventory": {"stock_in": "0", "stock_out": "0", "created_at": "current_timestamp()"},
}

# Header names of the exchange CSV files, in file order, with the
# column of the schema above that each one fills.
CSV_HEADERS = {
    "products": {
        "id_producto": "product_id",
        "sku": "sku",
        "nombre_producto": "product_name",
        "marca": "brand",
        "categoria": "category",
        "subcategoria": "subcategory",
        "precio_sugerido": "list_price",
    },
    "stores": {
        "id_tienda": "store_id",
        "codigo_tienda": "store_code",
        "nombre_tienda": "store_name",
        "cadena": "chain",
        "formato": "format",
        "region": "region",
        "ciudad": "city",
        "estado": "state",
        "superficie_m2": "floor_area_m2",
        "fecha_apertura": "opened_on",
    },
    "sales": {
        "id_producto": "product_id",
        "id_tienda": "store_id",
        "fecha": "sale_date",
        "hora": "sale_time",
        "ticket_id": "ticket_id",
        "cantidad": "quantity",
        "precio_unitario": "unit_price",
        "descuento_pct": "discount_pct",
        "canal": "channel",
    },
    "inventory": {
        "id_producto": "product_id",
        "id_tienda": "store_id",
        "fecha": "snapshot_date",
        "stock_inicial": "opening_stock",
        "stock_final": "final_stock",
        "entradas": "stock_in",
        "salidas": "stock_out",
        "costo_unitario": "unit_cost",
    },
}
