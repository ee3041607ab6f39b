"""Binning, flags and threshold labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last hour of every bin but the final one
# (0-5 -> 0, 6-9 -> 1, 10-14 -> 2, 15-20 -> 3, 21 and later -> 4).
DAY_PART_LAST_HOURS = (5, 9, 14, 20)
MORNING_BIN = 1
EVENING_BIN = 3


def bin_by_edges(col: Column, last_values: Sequence[float]) -> Column:
    """Number of the first bin whose last value is not exceeded; null stays null."""
    binned = reduce(
        lambda chain, item: chain.when(col <= item[1], F.lit(item[0])),
        enumerate(last_values),
        F.when(col.isNull(), F.lit(None).cast("int")),
    )
    return binned.otherwise(F.lit(len(last_values)))


def flag_in(col: Column, values: Sequence) -> Column:
    """1 when the value is listed, else 0 (null gives 0)."""
    return F.when(col.isin(*values), 1).otherwise(0)


def flag_range(col: Column, low: float, high: float) -> Column:
    """1 when ``low <= value < high``, else 0 (null gives 0)."""
    return F.when((col >= low) & (col < high), 1).otherwise(0)


def threshold_label(col: Column, limit: float, strict: bool = True) -> Column:
    """Binary label: more than the limit (or at least, when not strict); null stays null."""
    return ((col > limit) if strict else (col >= limit)).cast("int")
