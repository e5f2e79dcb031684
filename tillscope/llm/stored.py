"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillscope.sources.shared import fresh_folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read again: computed once, and not lost with an executor."""
    spark: SparkSession = df.sparkSession
    path = fresh_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
