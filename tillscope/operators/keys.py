"""Generated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def assign_keys(df: DataFrame, key: str, start_after: int = 0) -> DataFrame:
    """Unique, not consecutive keys above ``start_after``, without a shuffle.

    The key depends on a row's place in its partition. Call this on a table
    scan, where that place is fixed; after a shuffle a lost task that is run
    again could number its rows differently.
    """
    return df.withColumn(key, F.monotonically_increasing_id() + F.lit(start_after + 1))


#: Rows that one window of dense keys is meant to hold.
KEYS_A_PART = 1_000_000


def assign_dense_keys(
    df: DataFrame, key: str, order_by: list[str], start_after: int = 0, rows_a_part: int = KEYS_A_PART
) -> DataFrame:
    """Consecutive keys after ``start_after``; counts the rows while the plan is built.

    Rows are numbered inside hash parts of their natural key ``order_by`` (which
    must be unique) and shifted by the sizes of the parts before. The number of
    parts follows the rows, so a part holds some ``rows_a_part`` of them at any
    size, and a re-run gives the same keys. The one task that sums the sizes
    sees a row for each part.
    """
    parts = max(1, -(-df.count() // rows_a_part))
    rows = df.withColumn("_part", F.pmod(F.xxhash64(*order_by), F.lit(parts)))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order_by)
    number = F.lit(start_after) + F.col("_before") + F.row_number().over(inside)
    return rows.join(offsets, "_part").withColumn(key, number).drop("_part", "_before")


def next_key(df: DataFrame, key: str) -> DataFrame:
    """One row: the key after the largest one, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(key), F.lit(0)) + 1).alias("next_id"))


def key_status(spark: SparkSession, keyed: dict[str, tuple[DataFrame, str]], next_ids: dict[str, int]) -> DataFrame:
    """Next key against the largest stored key, per table."""
    checks = [
        df.agg(F.max(key).cast("bigint").alias("max_id")).select(
            F.lit(table).alias("table_name"),
            F.lit(next_ids[table]).cast("bigint").alias("next_id"),
            "max_id",
            (F.lit(next_ids[table]) > F.coalesce("max_id", F.lit(0))).alias("is_free"),
        )
        for table, (df, key) in keyed.items()
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
