"""Bitmaps of fixed size over 64-bit keys, to thin out rows before a join that decides."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """2**bits bits with those of the keys set by their top bits. At most 2**(bits - 6) rows reach the driver."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = keys.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("bits")
    )
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    found = words.toArrow()
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def within(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the bitmap; those that were put in always are."""
    place = keys.view(np.uint64) >> np.uint64(64 - (len(table) * 64).bit_length() + 1)
    return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
