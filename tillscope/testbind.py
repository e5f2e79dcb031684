"""The star schema read from the generic order tables used in tests.

Every expression is an integer or exact-decimal one, so that another SQL
engine can repeat it. Only tests, checks and the bench use this module.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.operators.calendar import calendar
from tillscope.star import Star

FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2001, 12, 31)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FORMATS = ("Super", "Express", "Hiper", "Convenience")


# Stated so that opening a table starts no job.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def _choose(number: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number.cast("int") + 1)


def _segment_number(segment: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), segment) - 1


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU"), F.col("p_partkey")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), F.col("p_size") % 5).alias("subcategory"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
        F.lit(True).alias("is_active"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """One store per nation and market segment."""
    nation, region = _read(spark, folder, "nation"), _read(spark, folder, "region")
    rows = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name", F.posexplode(F.array(*[F.lit(s) for s in SEGMENTS])).alias("i", "segment")
    )
    store_id = F.col("n_nationkey").cast("bigint") * 5 + F.col("i")
    return rows.select(
        store_id.alias("store_id"),
        F.concat(F.lit("T"), store_id).alias("store_code"),
        F.concat_ws(" ", "n_name", "segment").alias("store_name"),
        F.col("segment").alias("chain"),
        _choose(store_id % 4, FORMATS).alias("format"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("postal_code"),
        (F.lit(50) + (store_id * 37) % 4951).cast("int").alias("floor_area_m2"),
        F.lit(True).alias("is_active"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sale line per order line; the store comes from the customer."""
    lines = _read(spark, folder, "lineitem")
    customers = _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        (F.col("c_nationkey").cast("bigint") * 5 + _segment_number(F.col("c_mktsegment"))).alias("store_id"),
    )
    priority = F.substring("o_orderpriority", 1, 1)
    tickets = (
        _read(spark, folder, "orders")
        .join(customers, "o_custkey")
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            "store_id",
            F.col("o_orderdate").cast("date").alias("sale_date"),
            F.when(priority == "1", "online").when(priority == "2", "mobile").otherwise("in-store").alias("channel"),
        )
    )
    hour = F.lit(8) + F.col("l_orderkey") % 14
    return lines.join(tickets, "l_orderkey").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        "store_id",
        "sale_date",
        F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")).alias("sale_time"),
        F.col("l_orderkey").cast("string").alias("ticket_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.round(F.col("l_discount") * 100).cast("int").cast("decimal(5,2)").alias("discount_pct"),
        F.round(F.col("l_tax") * 100).cast("int").cast("decimal(5,2)").alias("tax_pct"),
        "channel",
        F.col("l_suppkey").alias("seller_id"),
    )


def inventory(spark: SparkSession, folder: str, sale_lines: DataFrame) -> DataFrame:
    """A snapshot on the first of each month for every pair sold in it."""
    product, store = F.col("product_id"), F.col("store_id")
    moved = (
        sale_lines.groupBy("product_id", "store_id", F.trunc("sale_date", "MM").alias("snapshot_date"))
        .agg(F.sum("quantity").cast("int").alias("stock_out"))
        .withColumn("_ym", F.year("snapshot_date") * 12 + F.month("snapshot_date"))
        .withColumn("_h", ((product * 11 + store * 3 + F.col("_ym") * 17) % 120).cast("int"))
        .withColumn("stock_in", F.least("stock_out", ((product * 7 + store * 13 + F.col("_ym") * 5) % 60).cast("int")))
        .withColumn(
            "final_stock",
            F.when(F.col("_h") <= 10, 0).when(F.col("_h") <= 30, F.col("_h") - 10).otherwise((F.col("_h") - 30) * 20),
        )
    )
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    cost = ((cents * 7 + 5) / 10).cast("bigint").cast("decimal(12,0)") * F.expr("0.01BD")
    costs = _read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), cost.cast("decimal(12,2)").alias("unit_cost")
    )
    return moved.join(costs, "product_id").select(
        ((product * 125 + store) * 100000 + F.col("_ym")).alias("inventory_id"),
        "product_id",
        "store_id",
        "snapshot_date",
        (F.col("final_stock") + F.col("stock_out") - F.col("stock_in")).alias("opening_stock"),
        "final_stock",
        "stock_in",
        "stock_out",
        "unit_cost",
        (F.col("final_stock") * F.col("unit_cost")).cast("decimal(15,2)").alias("stock_value"),
    )


def star(spark: SparkSession, folder: str) -> Star:
    bound = Star(
        products=lambda: products(spark, folder),
        stores=lambda: stores(spark, folder),
        calendar=lambda: calendar(spark, FIRST_DAY, LAST_DAY),
        sales=lambda: sales(spark, folder),
        inventory=lambda: inventory(spark, folder, bound.sales),
    )
    return bound


def _spoil(df: DataFrame, column: str, divisor: int, remainder: int, key: str, value: str) -> DataFrame:
    """Replace a column where ``key % divisor = remainder``."""
    kind = df.schema[column].dataType
    hit = F.col(key) % divisor == remainder
    return df.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)).cast(kind))


# (column, divisor, remainder, value) by table; the key is given beside it.
SPOILED = {
    "products": ("_key", [
        ("product_name", 7, 3, "'   '"),
        ("sku", 11, 5, "'SKU0'"),
        ("list_price", 13, 6, "-1"),
        ("subcategory", 17, 2, "'a subcategory name that is longer than fifty letters in all'"),
        ("brand", 19, 4, "NULL"),
        ("product_id", 29, 7, "NULL"),
    ]),
    "stores": ("_key", [
        ("store_name", 9, 2, "''"),
        ("store_code", 10, 3, "'T0'"),
        ("floor_area_m2", 8, 1, "0"),
        ("city", 11, 4, "NULL"),
        ("postal_code", 12, 5, "'12345-678901'"),
        ("store_id", 14, 6, "NULL"),
    ]),
    "sales": ("_key", [
        ("quantity", 101, 1, "0"),
        ("unit_price", 103, 2, "-1"),
        ("discount_pct", 107, 3, "150"),
        ("discount_pct", 109, 4, "NULL"),
        ("tax_pct", 113, 5, "-1"),
        ("channel", 127, 6, "'fax'"),
        ("channel", 131, 7, "'a channel of twenty-four'"),
        ("product_id", 137, 8, "-1"),
        ("product_id", 139, 9, "NULL"),
        ("store_id", 151, 11, "-1"),
        ("sale_date", 149, 10, "DATE '2090-01-01'"),
    ]),
    "inventory": ("_key", [
        ("final_stock", 101, 1, "-5"),
        ("opening_stock", 103, 2, "-5"),
        ("stock_in", 107, 3, "-1"),
        ("stock_out", 109, 4, "-1"),
        ("unit_cost", 113, 5, "-1"),
        ("unit_cost", 127, 6, "NULL"),
        ("snapshot_date", 131, 7, "DATE '2090-01-01'"),
        ("store_id", 137, 8, "-1"),
        ("product_id", 139, 9, "-1"),
    ]),
}
KEYS = {"products": "product_id", "stores": "store_id", "sales": "sale_id", "inventory": "inventory_id"}
REPEATED = {"products": 23, "stores": 13, "sales": 157, "inventory": 139}


def spoiled_star(spark: SparkSession, folder: str) -> Star:
    """The star with known faults in it, to give the quality rules something to find."""
    clean = star(spark, folder)

    def spoiled(table: str) -> DataFrame:
        key, faults = SPOILED[table]
        df = clean.table(table).withColumn(key, F.col(KEYS[table]))
        for column, divisor, remainder, value in faults:
            df = _spoil(df, column, divisor, remainder, key, value)
        copies = F.when(F.col(key) % REPEATED[table] == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return df.withColumn("_copy", F.explode(copies)).drop(key, "_copy")

    return Star(calendar=lambda: clean.calendar, **{t: partial(spoiled, t) for t in SPOILED})
