"""Checks after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def orphan_count(fact: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """Rows of a fact without a match in the dimension (NULL keys included).

    The fact is counted per key first, so only distinct keys are joined.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("rows"))
    orphans = per_key.join(dimension.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans")).select(
        F.lit(label).alias("check_type"), "orphans"
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, stacked."""
    counts = [
        df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def date_span(sales: DataFrame) -> DataFrame:
    """First, last and number of distinct sale dates."""
    return sales.agg(
        F.min("sale_date").alias("first_date"),
        F.max("sale_date").alias("last_date"),
        F.count_distinct("sale_date").alias("distinct_dates"),
    )


def table_sizes(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Files and bytes stored per table, largest first. File contents are not read."""
    sizes = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.lit(name).alias("table_name"), "length")
        for name, folder in folders.items()
    ]
    return (
        reduce(DataFrame.unionByName, sizes)
        .groupBy("table_name")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .orderBy(F.desc("bytes"))
    )


def profile_files(df: DataFrame) -> DataFrame:
    """Records and megabytes per source file of a file-backed DataFrame."""
    return (
        df.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file", "bytes")
        .agg(F.count("*").alias("records"))
        .select("file", "records", F.round(F.col("bytes") / 1048576.0, 2).alias("size_mb"))
        .orderBy("file")
    )
