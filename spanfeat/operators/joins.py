"""Equi-joins with conditions, dimension roles, and measure merging.

No side is broadcast by hint: the planner broadcasts when the size it measures (file
size, or shuffle size under adaptive execution) is small, and adaptive execution
splits skewed partitions of the shuffled joins otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns
from ..functions.packed import composite_key


def composite_key_join(
    left: DataFrame, right: DataFrame, left_key: str, right_parts: Sequence[Column], only: Column
) -> DataFrame:
    """Inner join of ``left_key`` with the concatenated key of the filtered right side."""
    dims = right.filter(only).withColumn("_key", composite_key(*right_parts))
    return left.join(dims, F.col(left_key) == F.col("_key")).drop("_key")


# Shortest chunk of time, as a power of two microseconds (about a second).
FIRST_CHUNK = 20


def _micros(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp"))


def _chunk_level(length: Column) -> Column:
    """Power of two of the shortest chunk that is not shorter than an interval."""
    bits = F.length(F.bin(F.greatest(length, F.lit(1)) - 1))
    return F.greatest(bits, F.lit(FIRST_CHUNK)).cast("int")


def validity_join(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    ts: str,
    begin: str,
    end: str,
    grace: timedelta = timedelta(hours=24),
    how: str = "inner",
) -> DataFrame:
    """Join facts to the dimension rows active at the fact's time.

    Active means ``begin <= ts <= end + grace``. ``key`` must exist on both sides;
    the dimension's other columns are appended. ``how`` is ``inner`` or ``left``. Rows whose
    key, instant or bound is null are never active; a left join keeps such facts.

    Facts and periods meet by (key, level, chunk of time). A period has the level of the
    shortest chunk, a power of two long, that is not shorter than itself, so it lies in one
    or two chunks and fills a quarter of them or more; a fact looks into one chunk of each
    level in use. Candidates grow with results, not with periods times facts of a key, and
    a hot key is spread over time. A fact lies in one chunk per level, so no pair meets
    twice. The levels in use, below 64, are looked up when this function is called.
    """
    require_columns(facts, [key, ts])
    require_columns(dims, [key, begin, end])
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    if how == "left":
        # instants are looked up once and joined back, so that a fact without a match stays
        asked = facts.select(F.col(key).alias("_ask_key"), F.col(ts).alias("_ask_ts")).dropna().distinct()
        renamed = dims.withColumnRenamed(key, "_ask_key")
        found = validity_join(asked, renamed, "_ask_key", "_ask_ts", begin, end, grace)
        same = (F.col(key) == F.col("_ask_key")) & (F.col(ts) == F.col("_ask_ts"))
        return facts.join(found, same, "left").drop("_ask_key", "_ask_ts")
    last = F.col(end) + F.lit(grace)
    start, stop = _micros(F.col(begin)), _micros(last)
    active = dims.withColumnRenamed(key, "_dim_key").filter(F.col(begin) <= last)
    active = active.withColumn("_level", _chunk_level(stop - start + 1))
    # fewer than 64 numbers, whatever the size of the table
    levels = sorted(r[0] for r in active.select("_level").distinct().collect() if r[0] is not None)
    if not levels:
        levels = [FIRST_CHUNK]

    def chunk(micros: Column, level: Column) -> Column:
        return F.floor(micros / F.pow(F.lit(2.0), level))

    periods = active.withColumn(
        "_chunk", F.explode(F.sequence(chunk(start, F.col("_level")), chunk(stop, F.col("_level"))))
    )
    looks = facts.withColumn("_fact_level", F.explode(F.array(*[F.lit(v) for v in levels]))).withColumn(
        "_fact_chunk", chunk(_micros(F.col(ts)), F.col("_fact_level"))
    )
    meets = (
        (F.col(key) == F.col("_dim_key"))
        & (F.col("_fact_level") == F.col("_level"))
        & (F.col("_fact_chunk") == F.col("_chunk"))
        & F.col(ts).between(F.col(begin), last)
    )
    return looks.join(periods, meets).drop("_dim_key", "_level", "_chunk", "_fact_level", "_fact_chunk")


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left rows whose key is absent on the right."""
    keys = as_list(on)
    return left.join(right.select(*keys), keys, "left_anti")


def matched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left rows whose key occurs on the right (semi-join: never multiplies rows)."""
    keys = as_list(on)
    return left.join(right.select(*keys), keys, "left_semi")


def join_roles(
    df: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: Mapping[str, str],
    cols: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join one dimension once per role; payload columns get the role's prefix.

    ``roles`` maps a key column of ``df`` to a prefix, e.g. ``{"ORIGIN": "ORIGIN_"}``.
    """
    require_columns(df, roles)
    require_columns(dim, [dim_key, *cols])
    for key, prefix in roles.items():
        side = dim.select(
            F.col(dim_key).alias("_role_key"), *[F.col(c).alias(f"{prefix}{c}") for c in cols]
        )
        df = df.join(side, F.col(key) == F.col("_role_key"), how).drop("_role_key")
    return df


def full_outer_merge(
    frames: Mapping[str, DataFrame], keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Full outer join of measure tables on their keys.

    ``frames`` maps a measure column to its frame (keys plus that column). All frames are
    stacked and grouped once instead of joined pairwise. A key with several rows in a table
    keeps all of them, paired with those of the other tables as a chain of full outer joins
    would; only such keys are joined, from the list of keys, so that no group is collected.
    With ``null_safe=False`` rows with a null in any key stay separate, as plain equality
    would keep them.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.select(
                *keys,
                *[
                    (F.col(m) if m == name else F.lit(None).cast(frames[m].schema[m].dataType)).alias(m)
                    for m in frames
                ],
                *[F.lit(int(m == name)).alias(f"_rows_{m}") for m in frames],
            )
            for name, df in frames.items()
        ],
    )

    def grouped(part: DataFrame) -> DataFrame:
        sums = part.groupBy(*keys).agg(
            *[F.max(m).alias(m) for m in frames], *[F.sum(f"_rows_{m}").alias(f"_rows_{m}") for m in frames]
        )
        alone = reduce(lambda a, b: a & b, [F.col(f"_rows_{m}") <= 1 for m in frames])
        many = sums.filter(~alone).select(*keys)
        for name, df in frames.items():
            side = df.select(*[F.col(k).alias(f"_key_{k}") for k in keys], name)
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
            many = many.join(side, same, "left").drop(*[f"_key_{k}" for k in keys])
        return sums.filter(alone).select(*keys, *frames).unionByName(many)

    if null_safe:
        return grouped(stacked)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return grouped(stacked.filter(whole)).unionByName(stacked.filter(~whole).select(*keys, *frames))


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of an ungrouped aggregate, which has exactly one row.

    They come from a scalar subquery, so rows of ``df`` are never lost or repeated: several
    rows raise an error when the result is computed, none gives nulls.
    """
    row = one_row.select(F.struct(*one_row.columns).alias("_row")).scalar()
    joined = df.withColumn("_row", row)
    return joined.select(*df.columns, *[F.col("_row")[c].alias(c) for c in one_row.columns])
