"""Joins, keys and reads whose tasks stay even, and what the optimizer knows."""

import statistics

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, rows, star
from tests.test_state import OLD, whole
from tillscope.operators.joins import HEAVY_KEYS, fits_broadcast, heavy_keys, with_product_of_lines
from tillscope.operators.keys import assign_dense_keys
from tillscope.operators.quality import mark
from tillscope.plans import tickets
from tillscope.sources.warehouse import Warehouse, analyze


@pytest.fixture
def settings(spark):
    """Set session settings for a test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark, n=9000, products=900):
    """Lines of which a third have product 7."""
    product = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % products).cast("bigint")
    return spark.range(0, n, 1, 6).select(F.col("id").alias("line"), product.alias("product_id"))


def catalogue(spark, products=900):
    return spark.range(products).select(F.col("id").alias("product_id"), F.concat(F.lit("C"), F.col("id") % 5).alias("category"))


def test_heavy_keys(spark):
    assert heavy_keys(skewed(spark), "product_id", share=0.05) == [7]
    assert heavy_keys(spark.range(1000).select(F.col("id").alias("k")), "k", share=0.01) == []
    none = spark.createDataFrame([(None,)], "k long")
    assert heavy_keys(none, "k") == [] and heavy_keys(none.limit(0), "k") == []
    many = spark.range(100000).select((F.col("id") % 50).alias("k"))
    assert sorted(heavy_keys(many, "k", share=0.01)) == list(range(50)) and 50 < HEAVY_KEYS


def test_no_task_gets_the_lines_of_a_hot_product(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="12",
    )
    lines, products = skewed(spark), catalogue(spark)
    joined = with_product_of_lines(lines, products, "category")
    sizes = rows(joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")), "n")
    assert max(sizes) <= 2 * statistics.median(sizes)
    plain = lines.join(products, "product_id")
    assert sorted(map(tuple, joined.select("line", "category").collect())) == sorted(map(tuple, plain.select("line", "category").collect()))
    worst = rows(plain.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")), "n")
    assert max(worst) > 2 * statistics.median(worst)


def test_a_small_catalogue_is_broadcast_without_a_sketch(spark, settings):
    products = catalogue(spark)
    assert fits_broadcast(products)
    plan = with_product_of_lines(skewed(spark), products, "category")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "BroadcastHashJoin" in plan
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert not fits_broadcast(products)


def test_references_are_checked_without_moving_lines(spark):
    s = star(spark, [{"sale_id": k, "product_id": 1} for k in range(20)] + [{"product_id": 5}], products=[{}])
    targets = {"products": s.products, "stores": s.stores, "calendar": s.calendar}
    marked = mark(s.sales, "sales", targets)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 1
    assert [r["product_id"] for r in marked.where("size(broken_rules) > 0").collect()] == [5]


def test_many_unknown_keys_are_joined(spark, monkeypatch):
    monkeypatch.setattr("tillscope.operators.quality.FEW_KEYS", 2)
    s = star(spark, [{"sale_id": k, "product_id": k} for k in range(1, 9)], products=[{}])
    marked = mark(s.sales, "sales", {"products": s.products})
    assert sorted(rows(marked.where("size(broken_rules) = 1"), "product_id")) == list(range(2, 9))


@pytest.mark.parametrize("rows_a_part", [7, 100, 1000000])
def test_dense_keys_at_any_part_size(spark, rows_a_part):
    df = spark.range(250).select(F.concat(F.lit("S"), F.col("id")).alias("sku"))
    keyed = assign_dense_keys(df, "k", ["sku"], start_after=10, rows_a_part=rows_a_part)
    first = sorted(rows(keyed, "sku", "k"))
    assert sorted(k for _, k in first) == list(range(11, 261))
    again = assign_dense_keys(df.repartition(5), "k", ["sku"], start_after=10, rows_a_part=rows_a_part)
    assert sorted(rows(again, "sku", "k")) == first
    assert assign_dense_keys(df.limit(0), "k", ["sku"]).count() == 0


def test_tickets_read_the_lines_of_the_range_once(spark, tmp_path, database):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    warehouse.write_star(whole(spark, *OLD))
    stored = warehouse.star()
    plan = tickets.weekly_ticket_by_format(stored, D("2024-01-01"), D("2024-02-29"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [part for part in text.split("FileScan parquet ")[1:] if "ticket_id" in part.split("]")[0] and ".sales__v" in part[:300]]
    assert len(scans) == 1 and "sale_month" in scans[0].split("PartitionFilters: [")[1].split("]")[0]
    want = tickets.weekly_ticket_by_format(whole(spark, *OLD), D("2024-01-01"), D("2024-02-29"))
    assert sorted(map(repr, want.collect())) == sorted(map(repr, plan.collect()))


def test_histograms_guide_estimates(spark, tmp_path, database, settings):
    warehouse = Warehouse(spark, database, str(tmp_path / "db"))
    dated = [{"sale_id": k, "sale_date": D("2024-01-01") if k < 90 else D("2024-06-01"), "product_id": k} for k in range(100)]
    warehouse.write_sales(star(spark, dated).sales)
    analyze(spark, warehouse.current_table("sales"), ["product_id", "sale_date"], histograms=True)
    settings(spark__sql__cbo__enabled="true")
    early = warehouse.table("sales").where("product_id < 90")
    stats = early._jdf.queryExecution().optimizedPlan().stats()
    assert 75 <= int(str(stats.rowCount().get())) <= 100
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"
