"""Global order without a single-task window: prefix sums, exact quantiles, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns
from ..session import cut_lineage


def _in_ranges(df: DataFrame, order: str, sums: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows range-partitioned by ``order`` with their range number, and sums per range.

    The rows are stored once, so that the range numbers are fixed for every later use.
    """
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    return ranged, totals.orderBy("_range")


def ordered_prefix(df: DataFrame, order: str, sums: Sequence[str]) -> DataFrame:
    """Add ``<col>_before``: the sum of ``col`` over all rows with a smaller ``order`` value.

    ``order`` must be unique. Each range of rows is scanned on its own and shifted by
    the total of the ranges below it; there is one total per range, so the window over
    totals is small.
    """
    require_columns(df, [order, *sums])
    ranged, totals = _in_ranges(df, order, sums)
    lower = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        "_range", *[F.coalesce(F.sum(c).over(lower), F.lit(0)).alias(f"_shift_{c}") for c in sums]
    )
    below = W.partitionBy("_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(shifts), "_range")
        .withColumns(
            {
                f"{c}_before": F.col(f"_shift_{c}") + F.coalesce(F.sum(c).over(below), F.lit(0))
                for c in sums
            }
        )
        .select(*df.columns, *[f"{c}_before" for c in sums])
    )


# Ranks that the sketch may be off by, as a share of all rows: 1 / ACCURACY.
ACCURACY = 10_000


def quantile_brackets(values: DataFrame, probs: Sequence[float], accuracy: int = ACCURACY) -> tuple[int, list]:
    """Number of values, and per probability two values that its neighbours lie between.

    ``values`` has one column v without nulls. Ranks come from Spark's mergeable sketch,
    asked two errors to either side, so a bracket holds about 4 / accuracy of all rows.
    """
    wide = 2.0 / accuracy
    asked = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-wide, wide)]
    row = values.agg(F.count("v").alias("n"), F.percentile_approx("v", asked, accuracy).alias("q")).first()
    if not row["n"]:
        return 0, []
    ends = row["q"]
    return row["n"], [
        (None if p - wide <= 0 else ends[2 * i], None if p + wide >= 1 else ends[2 * i + 1]) for i, p in enumerate(probs)
    ]


def exact_quantiles(
    df: DataFrame, col: str, probs: Sequence[float], accuracy: int = ACCURACY
) -> list[float | None]:
    """Exact quantiles with linear interpolation; nulls are ignored.

    A sketch brackets each quantile in a first pass. A second pass counts the values below
    each bracket and keeps those inside, equal ones counted; the wanted ranks are then found
    among the kept values in ranges, and only the neighbours of each quantile reach the
    driver. Should a sketch miss a rank, the search is repeated without its bracket.
    """
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n, brackets = quantile_brackets(values, probs, accuracy)
    if not n:
        return [None for _ in probs]
    places = [p * (n - 1) for p in probs]
    ranks = [(int(x), min(int(x) + 1, n - 1)) for x in places]
    found = _select_ranks(values, brackets, ranks)
    missed = [i for i, pair in enumerate(found) if None in pair]
    if missed:
        again = _select_ranks(values, [(None, None)] * len(missed), [ranks[i] for i in missed])
        for i, pair in zip(missed, again, strict=True):
            found[i] = pair
    return [low + (high - low) * (x - int(x)) for x, (low, high) in zip(places, found, strict=True)]


def _select_ranks(values: DataFrame, brackets: Sequence[tuple], ranks: Sequence[tuple[int, int]]) -> list[list]:
    """Values at the given ranks (two per bracket); None where a rank lies outside its bracket."""

    def below(bracket: tuple) -> Column:
        return F.lit(False) if bracket[0] is None else F.col("v") < bracket[0]

    def inside(bracket: tuple) -> Column:
        over = F.lit(False) if bracket[1] is None else F.col("v") > bracket[1]
        return ~below(bracket) & ~over

    # a set of small numbers says which brackets a value is in
    which = F.filter(F.array(*[F.when(inside(b), F.lit(i)) for i, b in enumerate(brackets)]), lambda i: i.isNotNull())
    kept = (
        values.withColumn("b", F.explode(which)).groupBy("b", "v").agg(F.count("*").alias("n"))
    )
    ranged = cut_lineage(kept.repartitionByRange("b", "v").withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range", "b").agg(F.sum("n").alias("n")).orderBy("b", "_range").collect()
    under = values.agg(*[F.count_if(below(b)).alias(f"c{i}") for i, b in enumerate(brackets)]).first()
    wanted = []  # (bracket, place in pair, range, rank within the range)
    for i, pair in enumerate(ranks):
        own = [r for r in sizes if r["b"] == i]
        for place, rank in enumerate(pair):
            at = rank - under[i]
            for r in own if at >= 0 else []:
                if at < r["n"]:
                    wanted.append((i, place, r["_range"], at))
                    break
                at -= r["n"]
    out: list[list] = [[None, None] for _ in ranks]
    if not wanted:
        return out
    upto = W.partitionBy("_range", "b").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    scanned = ranged.filter(F.col("_range").isin(sorted({w[2] for w in wanted}))).withColumn("_upto", F.sum("n").over(upto))

    def value_at(i: int, range_: int, at: int) -> Column:
        here = (F.col("b") == i) & (F.col("_range") == range_) & (F.col("_upto") > at) & (F.col("_upto") - F.col("n") <= at)
        return F.max(F.when(here, F.col("v")))

    row = scanned.agg(*[value_at(i, r, at).alias(f"r{k}") for k, (i, _, r, at) in enumerate(wanted)]).first()
    for k, (i, place, _, _) in enumerate(wanted):
        out[i][place] = row[k]
    return out


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of a total order (give a tie-break); every task keeps only k rows."""
    return df.orderBy(*order).limit(k)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Set union by column name."""
    return union_all(*frames).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    return df.select(*as_list(cols)).distinct()
