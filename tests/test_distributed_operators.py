"""Ranking, quantile and key operators against plain single-group forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillscope.operators.keys import assign_dense_keys, assign_keys, key_status, next_key
from tillscope.operators.quantile import weighted_quantile
from tillscope.operators.ranking import number_descending, rank_descending, value_band


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    data = [
        (i, "ab"[i % 2], rng.choice([None, 0.0, -5.25, 3.0, 3.0, round(rng.uniform(-1e4, 1e6), 2)]), rng.randint(1, 4))
        for i in range(2000)
    ]
    return spark.createDataFrame(data, "id int, g string, v double, w int").withColumn("v", F.col("v").cast("decimal(20,4)"))


def test_rank_equals_window_rank(values):
    expected = values.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_first("v"))))
    got = rank_descending(values, ["g"], "v", "r")
    assert sorted((x["id"], x["r"]) for x in got.collect()) == sorted((x["id"], x["r"]) for x in expected.collect())


def test_number_equals_row_number(values):
    order = Window.partitionBy("g").orderBy(F.desc_nulls_first("v"), "id")
    expected = values.withColumn("r", F.row_number().over(order))
    got = number_descending(values, ["g"], "v", "id", "r")
    assert sorted((x["id"], x["r"]) for x in got.collect()) == sorted((x["id"], x["r"]) for x in expected.collect())


def test_band_never_falls_with_the_value(values):
    bands = [r[0] for r in values.filter("v is not null").orderBy("v").select(value_band(F.col("v"))).collect()]
    assert bands == sorted(bands)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile_equals_exact_percentile(values, fraction):
    expected = values.groupBy("g").agg(F.percentile(F.col("v"), fraction, F.col("w")).alias("q"))
    got = weighted_quantile(values, ["g"], "v", "w", "q", fraction)
    want = {r["g"]: r["q"] for r in expected.collect()}
    assert {r["g"]: r["q"] for r in got.collect()} == pytest.approx(want)


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([("a", 7.0, 3)], "g string, v double, w int")
    assert weighted_quantile(df, ["g"], "v", "w", "q").collect()[0]["q"] == 7.0


def test_dense_keys_have_no_gaps_and_repeat(spark):
    df = spark.range(500).select(F.concat(F.lit("SKU"), "id").alias("sku")).repartition(7)
    first = assign_dense_keys(df, "key", ["sku"], start_after=10, rows_a_part=40)
    again = assign_dense_keys(df.repartition(3), "key", ["sku"], start_after=10, rows_a_part=40)
    keyed = {r["sku"]: r["key"] for r in first.collect()}
    assert sorted(keyed.values()) == list(range(11, 511))
    assert keyed == {r["sku"]: r["key"] for r in again.collect()}


def test_plain_keys_are_unique_above_the_start(spark):
    keys = [r["key"] for r in assign_keys(spark.range(100, numPartitions=5), "key", start_after=40).collect()]
    assert len(set(keys)) == 100 and min(keys) == 41


def test_next_key_of_empty_and_filled_tables(spark):
    df = spark.createDataFrame([(3,), (9,)], "k bigint")
    assert next_key(df, "k").first()["next_id"] == 10
    assert next_key(df.limit(0), "k").first()["next_id"] == 1
    status = key_status(spark, {"a": (df, "k"), "b": (df, "k")}, {"a": 10, "b": 9})
    assert {r["table_name"]: r["is_free"] for r in status.collect()} == {"a": True, "b": False}
