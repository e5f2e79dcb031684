"""Exact interpolated quantiles of weighted values, without collecting groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.operators.ranking import value_band

BANDS_PER_E_FOLD = 256


def weighted_quantile(
    df: DataFrame, keys: list[str], value: str, weight: str, name: str, fraction: float = 0.5
) -> DataFrame:
    """Continuous quantile of ``value`` counted ``weight`` times, per group.

    First a histogram over value bands finds the one or two bands that hold
    the wanted positions; then only the distinct values of those bands are
    counted through. Positions run from 0 to total - 1, and the result is
    interpolated between the values around ``fraction * (total - 1)``. Keys
    must not be NULL; groups without any value are left out. The band is never
    NULL, which keeps both uses of the counted values one and the same shuffle.
    """
    values = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.sum(weight).alias("_w"))
        .withColumn("_band", F.coalesce(value_band(F.col(value), BANDS_PER_E_FOLD), F.lit(0)))
    )
    group = Window.partitionBy(*keys)
    before_band = group.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    position = F.lit(fraction) * (F.col("_total") - 1)
    wanted = (
        values.groupBy(*keys, "_band")
        .agg(F.sum("_w").alias("_band_w"))
        .withColumn("_start", F.coalesce(F.sum("_band_w").over(before_band), F.lit(0)))
        .withColumn("_total", F.sum("_band_w").over(group))
        .withColumn("_low", F.floor(position))
        .withColumn("_high", F.ceil(position))
        .withColumn("_part", position - F.col("_low"))
        .filter((F.col("_start") <= F.col("_high")) & (F.col("_start") + F.col("_band_w") > F.col("_low")))
        .select(*keys, "_band", "_start", "_low", "_high", "_part")
    )
    before_value = Window.partitionBy(*keys, "_band").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        values.join(wanted, [*keys, "_band"])
        .withColumn("_from", F.col("_start") + F.coalesce(F.sum("_w").over(before_value), F.lit(0)))
        .withColumn("_to", F.col("_from") + F.col("_w"))
    )

    def holding(position_column: str):
        covers = (F.col("_from") <= F.col(position_column)) & (F.col(position_column) < F.col("_to"))
        return F.max(F.when(covers, F.col(value).cast("double")))

    ends = counted.groupBy(*keys).agg(
        holding("_low").alias("_a"), holding("_high").alias("_b"), F.max("_part").alias("_p")
    )
    return ends.select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_p")).alias(name))
