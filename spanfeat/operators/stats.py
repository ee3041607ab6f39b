"""Grouped statistics, shares, volumes and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_list
from ..session import settle
from . import gramian
from .joins import with_one_row
from .skew import spread_join


def group_stats(
    df: DataFrame, keys: str | Sequence[str], stats: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Grouped statistics; ``{"x": ["avg", "min"]}`` gives ``avg_x`` and ``min_x``."""
    known = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    return df.groupBy(*as_list(keys)).agg(
        *[known[kind](c).alias(f"{kind}_{c}") for c, kinds in stats.items() for kind in kinds]
    )


def frequency(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Rows and share of the whole per distinct combination."""
    counts = df.groupBy(*as_list(cols)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return with_one_row(counts, total).select(
        *as_list(cols), "n", (F.col("n") / F.col("_total")).alias("share")
    )


def label_rate(df: DataFrame, by: str | Sequence[str], label: str) -> DataFrame:
    """Rows, positives and positive share per value of ``by``."""
    return df.groupBy(*as_list(by)).agg(
        F.count("*").alias("n"),
        F.sum(F.col(label).cast("long")).alias("positives"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def hour_histogram(df: DataFrame, ts: str | Column, out: str = "hour") -> DataFrame:
    """Rows per clock hour."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return df.groupBy(F.hour(col).alias(out)).agg(F.count("*").alias("n"))


def daily_volume(
    df: DataFrame, roles: Mapping[str, tuple[str, str]], entity: str = "entity", day: str = "day"
) -> DataFrame:
    """Events per entity and day, by role.

    ``roles`` maps a role name to (entity column, time column), e.g.
    ``{"departures": ("origin", "dep_ts"), "arrivals": ("dest", "arr_ts")}``. The roles
    are stacked and grouped once.
    """
    stacked = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.col(e).alias(entity), F.to_date(t).alias(day), F.lit(role).alias("_role")
                    )
                    for role, (e, t) in roles.items()
                ]
            )
        ).alias("_r")
    ).select("_r.*")
    return (
        stacked.filter(F.col(entity).isNotNull() & F.col(day).isNotNull())
        .groupBy(entity, day)
        .agg(*[F.count_if(F.col("_role") == role).alias(role) for role in roles])
    )


def group_mean_diff(
    df: DataFrame, keys: Sequence[str], col: str, out: str, train: DataFrame | None = None
) -> DataFrame:
    """Difference from the group's mean, the mean taken on ``train`` (default: all rows).

    The means are pre-aggregated and joined; rows of a busy group are dealt over several tasks.
    Rows of groups unseen in training get null.
    """
    source = df if train is None else train
    means = settle(
        source.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(
            F.avg(col).alias("_mean")
        )
    )
    joined = spread_join(df, means, keys, few_keys=[f"_g{i}" for i in range(len(keys))], how="left")
    return joined.select(*df.columns, (F.col(col) - F.col("_mean")).alias(out))


def standardize(
    df: DataFrame, cols: Sequence[str], suffix: str = "_std", train: DataFrame | None = None
) -> DataFrame:
    """Columns scaled to mean 0 and standard deviation 1 (constant columns give 0)."""
    source = df if train is None else train
    fitted = source.agg(
        *[F.avg(c).alias(f"_avg_{c}") for c in cols],
        *[F.stddev(c).alias(f"_sd_{c}") for c in cols],
    )
    scaled = {
        f"{c}{suffix}": F.when(F.col(f"_sd_{c}") == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"_avg_{c}")) / F.nullif(F.col(f"_sd_{c}"), F.lit(0.0))
        )
        for c in cols
    }
    return with_one_row(df, fitted).select(*df.columns, *[e.alias(n) for n, e in scaled.items()])


def pairwise_products(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Interaction terms ``a_x_b`` for every pair of columns."""
    return df.withColumns(
        {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(cols, 2)}
    )


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, in one pass, as (a, b, corr).

    Rows with a null or NaN in either column are left out; a constant column gives null, as
    do pairs with fewer than two rows. See ``gramian.pair_moments``.
    """
    if len(cols) < 2:
        raise ValueError("a correlation needs two columns")
    names = F.array(*[F.lit(c) for c in cols])
    spread = F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))
    return gramian.pair_moments(df, cols).select(
        F.get(names, F.col("i")).alias("a"),
        F.get(names, F.col("j")).alias("b"),
        F.when((F.col("n") > 1) & (F.col("sxx") > 0) & (F.col("syy") > 0), F.col("sxy") / spread).alias("corr"),
    )


def drop_collinear(pairs: DataFrame, cols: Sequence[str], threshold: float) -> list[str]:
    """Columns to keep: of each strongly correlated pair, the one listed first.

    ``pairs`` has one row per pair of columns, so its size is set by the column list.
    """
    strong = {
        (r["a"], r["b"]) for r in pairs.filter(F.abs("corr") > threshold).select("a", "b").collect()
    }
    kept: list[str] = []
    for c in cols:
        if not any((k, c) in strong or (c, k) in strong for k in kept):
            kept.append(c)
    return kept


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Per class: rows and the balanced weight rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("_n"), F.count("*").alias("_k"))
    return with_one_row(counts, totals).select(
        label, "n", (F.col("_n") / (F.col("_k") * F.col("n"))).alias(out)
    )


def with_class_weights(df: DataFrame, weights: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Attach the fitted class weight to every row."""
    return df.join(settle(weights.select(label, out)), label, "left")
