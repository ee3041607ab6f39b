"""Missing-value tests: null, NaN and sentinel values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_or_nan(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type can hold NaN."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_missing(df: DataFrame, name: str, sentinels: Sequence = ()) -> Column:
    """Null, NaN, or one of the sentinel values; never null itself."""
    test = null_or_nan(df, name)
    return test | F.coalesce(F.col(name).isin(*sentinels), F.lit(False)) if sentinels else test


def sentinel_to_null(df: DataFrame, sentinels: Mapping[str, Sequence]) -> DataFrame:
    """Replace sentinel values (and NaN) by null, column by column."""
    return df.withColumns(
        {c: F.when(~is_missing(df, c, vals), F.col(c)) for c, vals in sentinels.items()}
    )


def valid_rows(df: DataFrame, sentinels: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose listed columns all hold a usable value."""
    for c, vals in sentinels.items():
        df = df.filter(~is_missing(df, c, vals))
    return df


def good_quality(col: Column, bad_codes: Sequence[str]) -> Column:
    """False for bad codes and for a missing code, as ``NOT IN`` drops nulls."""
    return F.coalesce(~col.isin(*bad_codes), F.lit(False))
