"""Time-ordered splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeexpr import instant


def slice_between(
    df: DataFrame, ts: str, begin: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rows with ``begin <= ts < end``; plain comparisons that reach the scan."""
    if begin is not None:
        df = df.filter(F.col(ts) >= instant(begin, df.schema[ts].dataType))
    return df.filter(F.col(ts) < instant(end, df.schema[ts].dataType)) if end is not None else df


def temporal_split(
    df: DataFrame,
    ts: str,
    cuts: Sequence[datetime],
    names: Sequence[str] = ("train", "validation", "test"),
    out: str = "split",
) -> DataFrame:
    """Name the time slice of each row; slice i ends before cut i. A null time gives null."""
    if len(names) != len(cuts) + 1:
        raise ValueError("one name more than cuts")
    kind = df.schema[ts].dataType
    label = F.when(F.col(ts).isNull(), F.lit(None).cast("string"))
    for name, cut in zip(names, cuts, strict=False):
        label = label.when(F.col(ts) < instant(cut, kind), F.lit(name))
    return df.withColumn(out, label.otherwise(F.lit(names[-1])))


def rolling_splits(
    df: DataFrame, ts: str, first_test_year: int, last_test_year: int, train_years: int, step: int = 1
) -> DataFrame:
    """One copy of a row per fold it belongs to, with ``fold`` (the test year) and ``role``.

    A fold trains on the ``train_years`` years before its test year.
    """
    kind = df.schema[ts].dataType

    def year_start(year: int) -> Column:
        return instant(datetime(year, 1, 1), kind)

    folds = []
    for year in range(first_test_year, last_test_year + 1, step):
        test = (F.col(ts) >= year_start(year)) & (F.col(ts) < year_start(year + 1))
        train = (F.col(ts) >= year_start(year - train_years)) & (F.col(ts) < year_start(year))
        folds.append(
            F.when(train, F.struct(F.lit(year).alias("fold"), F.lit("train").alias("role"))).when(
                test, F.struct(F.lit(year).alias("fold"), F.lit("test").alias("role"))
            )
        )
    return df.withColumn("_fold", F.explode(F.array_compact(F.array(*folds)))).select(
        *df.columns, "_fold.fold", "_fold.role"
    )


def entity_quarter_slice(
    df: DataFrame, entity: str, names: Sequence, ts: str, year: int, quarter: int
) -> DataFrame:
    """Rows of the named entities in one quarter of one year."""
    begin = datetime(year, 3 * quarter - 2, 1)
    end = datetime(year + (quarter == 4), (3 * quarter) % 12 + 1, 1)
    return slice_between(df, ts, begin, end).filter(F.col(entity).isin(*names))
