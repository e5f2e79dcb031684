"""Ranks and row numbers over groups too large for one task.

A window over a group sends the whole group to one task. Here a group is first
cut into value bands by a fixed function of the value, so that equal values
fall into one band and bands are ordered like the values. Positions are counted
inside a band and shifted by the number of rows in the bands before it. The
band depends on the value alone, so tasks that are run again agree with it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.sources.shared import materialized

BANDS_PER_E_FOLD = 64
MISSING_BAND = 2**31 - 1  # rows without a value come first in falling order


def value_band(value: Column, per_e_fold: int = BANDS_PER_E_FOLD) -> Column:
    """Band number, never falling with the value; logarithmic in its size."""
    number = value.cast("double")
    size = F.floor(F.log1p(F.abs(number)) * per_e_fold)
    return F.when(number < 0, -size - 1).otherwise(size).cast("int")


def _with_band(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("_band", F.coalesce(value_band(F.col(value)), F.lit(MISSING_BAND)))


def _rows_above(banded: DataFrame, keys: list[str], rows: Column) -> DataFrame:
    """Per group and band: the number of rows in higher bands."""
    above = Window.partitionBy(*keys).orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = banded.groupBy(*keys, "_band").agg(rows.alias("_band_rows"))
    return sizes.select(
        *keys, "_band", F.coalesce(F.sum("_band_rows").over(above), F.lit(0)).alias("_rows_above")
    )


def rank_descending(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``rank()`` by falling ``value`` within ``keys``; keys must not be NULL.

    Distinct values are counted and ranked, and rows take the rank of their
    value, so even a value that most rows share is no burden on one task.
    ``df`` is read twice from a stored copy.
    """
    df = materialized(df)
    counts = _with_band(df.groupBy(*keys, value).agg(F.count("*").alias("_n")), value)
    greater = (
        Window.partitionBy(*keys, "_band")
        .orderBy(F.desc_nulls_first(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counts.join(_rows_above(counts, keys, F.sum("_n")), [*keys, "_band"]).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(value).alias("_value"),
        (F.col("_rows_above") + F.coalesce(F.sum("_n").over(greater), F.lit(0)) + 1).alias(name),
    )
    same = F.col(value).eqNullSafe(F.col("_value"))
    for key in keys:
        same = same & (F.col(key) == F.col(f"_key_{key}"))
    return df.join(ranks, same).drop("_value", *[f"_key_{k}" for k in keys])


def number_descending(df: DataFrame, keys: list[str], value: str, tiebreak: str, name: str) -> DataFrame:
    """``row_number()`` by falling ``value``, then rising ``tiebreak`` (a number, not NULL), within ``keys`` (not NULL).

    Rows are numbered inside bands of the value. Equal values share a band, and
    a value that most rows have would fill one task, so every value is cut once
    more, into bands of the tiebreak. ``df`` is read twice from a stored copy.
    """
    rows = _with_band(materialized(df), value).withColumn("_tie_band", value_band(F.col(tiebreak)))
    cell = [*keys, "_band", value, "_tie_band"]
    sizes = rows.groupBy(*cell).agg(F.count("*").alias("_cell_rows"))
    order = Window.partitionBy(*keys, "_band").orderBy(F.desc_nulls_first(value), "_tie_band")
    before = F.coalesce(F.sum("_cell_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = sizes.withColumn("_before", before).join(
        _rows_above(sizes, keys, F.sum("_cell_rows")), [*keys, "_band"]
    )
    offsets = above.select(
        *[F.col(c).alias(f"_cell_{i}") for i, c in enumerate(cell)], (F.col("_rows_above") + F.col("_before")).alias("_offset")
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_cell_{i}")) for i, c in enumerate(cell)])
    inside = Window.partitionBy(*cell).orderBy(tiebreak)
    return (
        rows.join(offsets, same)
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .drop("_band", "_tie_band", "_offset", *[f"_cell_{i}" for i in range(len(cell))])
    )


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, name: str, number: Callable[[], Column] = F.row_number
) -> DataFrame:
    """First ``n`` rows per group.

    Spark cuts to ``n`` per task before it shuffles while ``n`` is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 by default).
    """
    numbered = df.withColumn(name, number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(name) <= n)
