import pytest
from pyspark.sql import functions as F

from tests.helpers import D, SALE, frame, rows, star
from tillscope.operators import quality
from tillscope.operators.validate import date_span, orphan_count, table_counts


def findings(s, *rule_ids):
    got = quality.check(s, set(rule_ids)).filter("violations > 0").collect()
    return {(r["rule_id"], r["table_name"], r["violations"]) for r in got}


def test_clean_star_has_no_findings(spark):
    s = star(spark, [{}], [{}])
    assert quality.check(s).filter("violations > 0").count() == 0


LONG = "x" * 300
SALES_FAULTS = {
    "DQ8": {"quantity": 0}, "DQ9": {"unit_price": -1}, "DQ10": {"discount_pct": 101}, "DQ11": {"tax_pct": -1},
    "DQ17": {"channel": "fax"}, "DQ5": {"quantity": None}, "DQ20": {"sale_date": D("2030-01-01")},
    "DQ22": {"sale_date": D("2030-01-01")}, "DQ21": {"ticket_id": LONG},
}


@pytest.mark.parametrize("rule_id", SALES_FAULTS)
def test_one_faulty_sale(spark, rule_id):
    s = star(spark, [{}, {"sale_id": 2, **SALES_FAULTS[rule_id]}], [{}])
    assert findings(s, rule_id) == {(rule_id, "sales", 1)}


INVENTORY_FAULTS = {
    "DQ12": {"final_stock": -1}, "DQ13": {"stock_in": -1}, "DQ14": {"unit_cost": -1}, "DQ18": {"stock_out": 1},
}


@pytest.mark.parametrize("rule_id", INVENTORY_FAULTS)
def test_one_faulty_snapshot(spark, rule_id):
    other = {"inventory_id": 2, "snapshot_date": D("2024-05-01"), **INVENTORY_FAULTS[rule_id]}
    assert findings(star(spark, [], [{}, other]), rule_id) == {(rule_id, "inventory", 1)}


def test_dimension_rules(spark):
    s = star(
        spark, [], [],
        products=[{}, {"product_id": 2}, {"product_id": 3, "sku": "P3", "product_name": " ", "list_price": -1}],
        stores=[{}, {"store_id": 2}, {"store_id": 3, "store_code": "T3", "store_name": "", "floor_area_m2": 0}],
    )
    assert findings(s, "DQ2", "DQ3", "DQ6", "DQ7", "DQ15", "DQ16") == {
        ("DQ2", "products", 1), ("DQ3", "stores", 1), ("DQ6", "products", 1), ("DQ7", "stores", 1),
        ("DQ15", "products", 1), ("DQ16", "stores", 1),
    }


def test_keys_and_references(spark):
    s = star(
        spark,
        [{}, {}, {"sale_id": 2, "product_id": 99}, {"sale_id": 3, "store_id": None}],
        [{}, {"inventory_id": 2}],
    )
    assert findings(s, "DQ1", "DQ4", "DQ19") == {
        ("DQ1", "sales", 1), ("DQ4", "inventory", 1), ("DQ19", "sales", 1)
    }


def test_null_breaks_a_primary_but_not_a_unique_key(spark):
    s = star(spark, [], [], products=[{}, {"product_id": None, "sku": None}, {"product_id": 3, "sku": None}])
    assert findings(s, "DQ1") == {("DQ1", "products", 1)}
    assert findings(s, "DQ2") == set()


def test_null_passes_a_condition(spark):
    s = star(spark, [{"discount_pct": None, "tax_pct": None, "channel": None}])
    assert findings(s, "DQ10", "DQ11", "DQ17") == set()


def test_split_keeps_every_row_once(spark):
    s = star(spark)
    lines = frame(spark, "sales", SALE, [
        {}, {"sale_id": 2, "quantity": 0, "unit_price": -1}, {"sale_id": 3, "product_id": 9},
        {"sale_id": 4, "discount_pct": None}, {"sale_id": 5, "sale_date": D("2031-01-01"), "store_id": 7},
    ])
    targets = {"products": s.products, "stores": s.stores, "calendar": s.calendar}
    valid, rejected = quality.split(lines, "sales", targets)
    assert sorted(rows(valid, "sale_id")) == [1, 4]
    assert {r["sale_id"]: sorted(r["broken_rules"]) for r in rejected.collect()} == {
        2: ["DQ8", "DQ9"], 3: ["DQ19"], 5: ["DQ19", "DQ20"]
    }


def test_every_copy_of_a_repeated_key_is_rejected(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    marked = df.withColumn("broken_rules", F.array().cast("array<string>"))
    broken = lambda **o: sorted(rows(quality.mark_duplicates(marked, ("k",), "DQ4", **o).filter("size(broken_rules) > 0"), "v"))
    assert broken() == ["a", "b"]
    assert broken(primary=True) == ["a", "b", "d", "e"]


def test_validation_counts(spark):
    s = star(spark, [{}, {"product_id": 5}, {"product_id": None, "sale_date": D("2024-06-06")}], [{}])
    assert rows(orphan_count(s.sales, s.products, "product_id", "x"), "orphans") == [2]
    assert dict(rows(table_counts(s.tables()), "table_name", "record_count")) == {
        "products": 1, "stores": 1, "calendar": 366, "sales": 3, "inventory": 1
    }
    assert tuple(date_span(s.sales).first()) == (D("2024-06-05"), D("2024-06-06"), 2)


def test_row_rules_of_a_table_are_one_aggregate(spark):
    s = star(spark, [{}])
    (checked,) = quality.check_table(s, "sales", lambda rule_id: rule_id not in ("DQ19", "DQ20", "DQ22"))
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert checked.count() == len([r for r in quality.ROW_RULES if r.table == "sales"])
    assert checked.agg(F.sum("violations")).first()[0] == 0


def test_references_give_the_same_counts_without_broadcast(spark):
    s = star(spark, [{}, {"product_id": 8}, {"store_id": 9}, {"store_id": None, "sale_date": D("2030-01-01")}], [{}])
    together = findings(s, "DQ19", "DQ20")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(quality.check_table(s, "sales", lambda rule_id: rule_id == "DQ19")) == 2
        assert findings(s, "DQ19", "DQ20") == together
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("DQ20", "sales", 1) in together
