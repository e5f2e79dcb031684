"""Money and ratio expressions shared by all plans.

Money stays decimal until it is divided: a line's net sale is kept as
``quantity * price * (100 - discount)``, i.e. one hundred times the net value,
which is an exact decimal. Sums of it are exact whatever the order of the rows,
so results do not depend on partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NET_X100 = "net_x100"
_HUNDREDTH = Decimal("0.01")


def line_net_x100() -> Column:
    """One hundred times the net value of a sale line, exact."""
    return F.col("quantity") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))


def with_net(sales: DataFrame) -> DataFrame:
    return sales.withColumn(NET_X100, line_net_x100())


def money(net_x100_sum: Column) -> Column:
    """An exact decimal amount from a sum of ``net_x100``."""
    return net_x100_sum * F.lit(_HUNDREDTH)


def net_sales() -> Column:
    return money(F.sum(NET_X100))


def gross_value() -> Column:
    """Line value before discount."""
    return F.col("quantity") * F.col("unit_price")


def real(amount: Column | str) -> Column:
    return (F.col(amount) if isinstance(amount, str) else amount).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; NULL instead of an error on a zero denominator."""
    return F.try_divide(real(numerator), real(denominator))


def change_pct(now: Column | str, before: Column | str) -> Column:
    """Relative change in percent, two decimals; NULL without a base."""
    new, old = real(now), real(before)
    return F.round(F.try_divide(new - old, old) * F.lit(100.0), 2)


def share_pct(part: Column | str, whole: Column | str) -> Column:
    return F.round(ratio(part, whole) * F.lit(100.0), 2)
