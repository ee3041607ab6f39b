"""Joins that split hot keys: frequencies first, then salts for the few keys that need them.

A key is heavy when its rows exceed a set share of a task's fair part. At most ``SHARE`` x
tasks keys can be heavy, so their list has a proven bound and may be broadcast whatever the
size of the table. Rows of a heavy key are dealt over several salts, and the other side's
rows of that key are repeated once per salt. All other keys keep one partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns

# Keys with more rows than 1 / SHARE of a task's fair part are split.
SHARE = 4


def tasks_of(df: DataFrame) -> int:
    """Partitions of a shuffle in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(counts: DataFrame, keys: Sequence[str], n: str, tasks: int) -> DataFrame:
    """(keys, _salts) of the heavy keys in a table of row counts per key; null keys are left out.

    At most ``SHARE`` x ``tasks`` rows.
    """
    total = counts.agg(F.sum(n).alias("_n")).select((F.col("_n") / (SHARE * tasks)).alias("_limit")).scalar()
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        counts.filter(present)
        .withColumn("_limit", total)
        .filter(F.col(n) > F.col("_limit"))
        .select(*keys, F.ceil(F.col(n) / F.col("_limit")).cast("int").alias("_salts"))
    )


def spread_join(
    many: DataFrame,
    few: DataFrame,
    keys: str | Sequence[str],
    few_keys: str | Sequence[str] | None = None,
    how: str = "inner",
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` to ``few`` on equal keys, with the rows of heavy keys dealt over tasks.

    ``how`` is inner, left, left_semi or left_anti. ``heavy`` comes from ``heavy_keys``; when
    absent, the keys of ``many`` are counted, one more pass over its key columns. Rows are
    dealt by a hash of their whole content, rows with a null key as well. The key columns of
    ``few`` are dropped.
    """
    keys = as_list(keys)
    few_keys = as_list(few_keys) if few_keys is not None else keys
    require_columns(many, keys)
    require_columns(few, few_keys)
    tasks = tasks_of(many)
    if heavy is None:
        heavy = heavy_keys(many.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "_n", tasks)
    heavy = heavy.select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)], "_salts")

    def with_salts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_hot{i}") for i, c in enumerate(cols)])
        # at most SHARE x tasks rows
        return df.join(F.broadcast(heavy), same, "left").drop(*[f"_hot{i}" for i in range(len(cols))])

    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = F.pmod(F.xxhash64(*many.columns), F.when(absent, F.lit(SHARE * tasks)).otherwise(F.coalesce("_salts", F.lit(1))))
    left = with_salts(many, keys).withColumn("_salt", dealt).drop("_salts")
    renamed = few.withColumnsRenamed({k: f"_few{i}" for i, k in enumerate(few_keys)})
    right = (
        with_salts(renamed, [f"_few{i}" for i in range(len(keys))])
        .withColumn("_few_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    same: Column = F.col("_salt") == F.col("_few_salt").cast("long")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_few{i}"))
    joined = left.join(right, same, how)
    return joined.drop("_salt", "_few_salt", *[f"_few{i}" for i in range(len(keys))])
