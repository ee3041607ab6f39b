"""Null profiles, cleaning, audits and loss reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns
from ..functions.missing import null_or_nan
from .ordering import exact_quantiles


def null_profile(
    df: DataFrame, cols: Sequence[str] | None = None, by: str | Sequence[str] = ()
) -> DataFrame:
    """Null-or-NaN count of every column in one pass, as (by..., column, nulls, total)."""
    keys = as_list(by)
    cols = [c for c in (cols or df.columns) if c not in keys]
    require_columns(df, [*cols, *keys])
    counts = df.groupBy(*keys).agg(
        F.count("*").alias("_total"),
        *[F.count_if(null_or_nan(df, c)).alias(c) for c in cols],
    )
    return counts.unpivot([*keys, "_total"], list(cols), "column", "nulls").withColumnRenamed(
        "_total", "total"
    )


def drop_sparse_columns(df: DataFrame, max_null_frac: float = 0.8) -> DataFrame:
    """Drop columns whose null share exceeds the limit (one row reaches the driver)."""
    shares = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(null_or_nan(df, c)).alias(c) for c in df.columns],
    ).first()
    total = shares["_total"]
    return df.drop(*[c for c in df.columns if total and shares[c] / total > max_null_frac])


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without any null (or NaN) in the subset."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def exclude_flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Drop rows with any flag set, e.g. cancelled or diverted; a missing flag counts as not set."""
    for flag in flags:
        df = df.filter(F.coalesce(F.col(flag).cast("double"), F.lit(0.0)) == 0)
    return df


def filter_outliers(
    df: DataFrame,
    col: str,
    low: float | None = None,
    high: float | None = None,
    iqr_k: float | None = None,
    keep_null: bool = True,
) -> DataFrame:
    """Keep values inside fixed bounds, or inside k interquartile ranges of the quartiles.

    Rows without a value stay, unless ``keep_null`` is off.
    """
    if iqr_k is not None:
        q1, q3 = exact_quantiles(df, col, [0.25, 0.75])
        if q1 is None:
            return df if keep_null else df.filter(F.col(col).isNotNull())
        low, high = q1 - iqr_k * (q3 - q1), q3 + iqr_k * (q3 - q1)
    inside = F.col(col).isNotNull()
    if low is not None:
        inside &= F.col(col) >= low
    if high is not None:
        inside &= F.col(col) <= high
    return df.filter(inside | F.col(col).isNull() if keep_null else inside)


def loss_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and columns before, after and lost, with percentages."""
    counts = (
        before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
        .unionAll(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
        .agg(
            F.coalesce(F.sum("b"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("a"), F.lit(0)).alias("rows_after"),
        )
    )
    n_before, n_after = len(before.columns), len(after.columns)
    lost = F.col("rows_before") - F.col("rows_after")
    return counts.select(
        "rows_before",
        "rows_after",
        lost.alias("rows_lost"),
        F.round(100 * lost / F.nullif("rows_before", F.lit(0)), 6).alias("rows_lost_pct"),
        F.lit(n_before - n_after).cast("long").alias("columns_lost"),
        F.lit(round(100 * (n_before - n_after) / n_before, 6)).alias("columns_lost_pct"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def dedupe_keys(df: DataFrame, keys: Sequence[str], stats: Mapping) -> DataFrame:
    """One row per key, other columns combined by the given aggregates."""
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in stats.items()])


def coverage_profile(df: DataFrame, entity: str, ts: str, expected: int = 24) -> DataFrame:
    """Distribution of mean observations per day over entities.

    Per entity: rows / days with rows, rounded down to whole observations; then the
    number of entities at each level and whether the level meets ``expected``.
    """
    per_day = df.groupBy(entity, F.to_date(ts).alias("_day")).agg(F.count("*").alias("_n"))
    per_entity = per_day.groupBy(entity).agg(F.floor(F.avg("_n")).cast("long").alias("obs_per_day"))
    return (
        per_entity.groupBy("obs_per_day")
        .agg(F.count("*").alias("entities"))
        .withColumn("complete", (F.col("obs_per_day") >= expected).cast("int"))
    )
