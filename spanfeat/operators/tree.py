"""Decision tree that learns where missing values go, from histograms made by Spark.

Level by level, one grouping counts the rows of every open node per feature and bin; the
split search runs over these counts, in windows per node and feature. A number is split at
a bin's edge, a category by a subset: its values are put in the order of their label rate,
and the best subset is a prefix of that order. For every candidate the rows without a value
are tried on both sides, and the better side is kept as the node's default. Only the winning
split of each node reaches the driver, below 2 ** depth rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.checks import require_columns
from ..session import staged

# Gains are compared after rounding to this many places, so that ties are ties everywhere.
PLACES = 9


@dataclass(frozen=True)
class Split:
    """Rows with ``feature`` at most ``threshold``, or in ``left_values``, go left."""

    feature: str
    threshold: float | None
    left_values: tuple[str, ...] | None
    default_left: bool
    gain: float
    left_weight: float
    right_weight: float

    def goes_left(self) -> Column:
        if self.threshold is not None:
            x = F.col(self.feature).cast("double")
            absent, inside = x.isNull() | F.isnan(x), x <= self.threshold
        else:
            x = F.col(self.feature).cast("string")
            absent, inside = x.isNull(), x.isin(list(self.left_values))
        return F.when(absent, F.lit(self.default_left)).otherwise(inside)


@dataclass(frozen=True)
class TreeModel:
    """Splits by node number (root 1, children 2k and 2k + 1) and label rate of every node."""

    splits: Mapping[int, Split]
    rates: Mapping[int, float]

    def node(self) -> Column:
        """Leaf a row falls into."""

        def below(k: int) -> Column:
            if k not in self.splits:
                return F.lit(k)
            return F.when(self.splits[k].goes_left(), below(2 * k)).otherwise(below(2 * k + 1))

        return below(1)

    def probability(self) -> Column:
        """Label rate of the row's leaf."""

        def below(k: int) -> Column:
            if k not in self.splits:
                return F.lit(float(self.rates[k]))
            return F.when(self.splits[k].goes_left(), below(2 * k)).otherwise(below(2 * k + 1))

        return below(1)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns prediction and probability, as classifiers of Spark ML give them."""
        return df.withColumn("_p", self.probability()).select(
            *df.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per inner node."""
        rows = [
            (k, s.feature, s.threshold, None if s.left_values is None else ",".join(s.left_values), s.default_left,
             s.gain, s.left_weight, s.right_weight)
            for k, s in sorted(self.splits.items())
        ]
        return spark.createDataFrame(
            rows,
            "node int, feature string, threshold double, left_values string, default_left boolean, gain double,"
            " left_weight double, right_weight double",
        )

    def importances(self) -> dict[str, float]:
        """Share of the total weighted gain per feature."""
        sums: dict[str, float] = {}
        for s in self.splits.values():
            sums[s.feature] = sums.get(s.feature, 0.0) + s.gain * (s.left_weight + s.right_weight)
        total = sum(sums.values())
        return {f: v / total for f, v in sums.items()} if total else {}


def _number(c: str) -> Column:
    """A double, with NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def cut_points(df: DataFrame, numeric: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Upper edges of the bins of every number, ascending, without the largest value.

    All distinct values where there are at most ``bins``, else values at even ranks from
    Spark's quantile sketch.
    """
    if not numeric:
        return {}
    rough = df.agg(*[F.approx_count_distinct(_number(c)).alias(c) for c in numeric]).first()
    few = [c for c in numeric if rough[c] <= 2 * bins]
    edges: dict[str, list[float]] = {}
    if few:
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _number(c).alias("v")) for c in few])).alias("r"))
        # about 2 * bins rows per column
        found = stacked.select("r.*").filter("v IS NOT NULL").distinct().collect()
        for c in few:
            own = sorted(r["v"] for r in found if r["c"] == c)
            if len(own) <= bins:
                edges[c] = own
    rest = [c for c in numeric if c not in edges]
    if rest:
        ranks = [i / bins for i in range(1, bins + 1)]
        row = df.agg(*[F.percentile_approx(_number(c), ranks, 100 * bins).alias(c) for c in rest]).first()
        edges |= {c: sorted(set(row[c] or [])) for c in rest}
    return {c: edges[c][:-1] for c in numeric}


def _histograms(rows: DataFrame, node: Column, features: Sequence[str]) -> DataFrame:
    """(node, feature, bin, w, wy) over all rows; bin null holds the rows without a value."""
    stacked = F.array(
        *[F.struct(F.lit(i).alias("feature"), F.col(f"f{i}").alias("bin")) for i in range(len(features))]
    )
    return (
        rows.select(node.alias("node"), "w", (F.col("w") * F.col("y")).alias("wy"), F.explode(stacked).alias("r"))
        .filter("node IS NOT NULL")
        .groupBy("node", "r.feature", "r.bin")
        .agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    )


def _impurity(w: Column, wy: Column) -> Column:
    """Gini impurity times weight; 0 for an empty side."""
    return F.when(w > 0, 2 * wy * (w - wy) / w).otherwise(0.0)


def best_splits(histograms: DataFrame, numeric: int) -> DataFrame:
    """The winning split of every node: feature, position in its order, bins on the left, side of the missing.

    Features below ``numeric`` are ordered by bin, others by label rate. Ties go to the
    feature listed first, then to fewer values on the left, then to missing on the left.
    """
    own = W.partitionBy("node", "feature")
    held = histograms.filter("bin IS NOT NULL")
    rate = F.when(F.col("feature") < numeric, F.lit(0.0)).otherwise(F.round(F.col("wy") / F.col("w"), PLACES))
    upto = own.orderBy("rate", "key", "bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = (
        held.withColumn("rate", rate)
        .withColumn("key", F.when(F.col("feature") < numeric, F.col("bin").cast("int")))
        .withColumns({
            "lw": F.sum("w").over(upto), "lwy": F.sum("wy").over(upto), "at": F.row_number().over(own.orderBy("rate", "key", "bin")),
            "n": F.count("*").over(own), "hw": F.sum("w").over(own), "hwy": F.sum("wy").over(own),
            "left_bins": F.collect_list("bin").over(upto),
        })
        .filter("at < n")
    )
    missing = histograms.filter("bin IS NULL").select("node", "feature", F.col("w").alias("mw"), F.col("wy").alias("mwy"))
    joined = ordered.join(missing, ["node", "feature"], "left").na.fill(0.0, ["mw", "mwy"])
    tried = joined.withColumn("default_left", F.explode(F.array(F.lit(True), F.lit(False))))
    tried = tried.withColumns({
        "left_w": F.col("lw") + F.when(F.col("default_left"), F.col("mw")).otherwise(0.0),
        "left_wy": F.col("lwy") + F.when(F.col("default_left"), F.col("mwy")).otherwise(0.0),
        "all_w": F.col("hw") + F.col("mw"), "all_wy": F.col("hwy") + F.col("mwy"),
    })
    right_w, right_wy = F.col("all_w") - F.col("left_w"), F.col("all_wy") - F.col("left_wy")
    loss = _impurity(F.col("left_w"), F.col("left_wy")) + _impurity(right_w, right_wy)
    gain = F.round((_impurity(F.col("all_w"), F.col("all_wy")) - loss) / F.col("all_w"), PLACES)
    # without missing rows both sides are alike: the heavier side becomes the default
    heavier = (F.col("mw") > 0) | (F.col("default_left") == (F.col("left_w") >= right_w))
    tried = tried.withColumn("gain", gain).filter(heavier & (F.col("gain") > 0))
    best = F.struct((-F.col("gain")).alias("g"), "feature", "at", (~F.col("default_left")).alias("d"))
    row = F.struct(
        "feature", "left_bins", "default_left", "gain", "left_w", right_w.alias("right_w"),
        "left_wy", right_wy.alias("right_wy"),
    )
    return tried.groupBy("node").agg(F.min_by(row, best).alias("s")).select("node", "s.*")


def fit_tree(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    weight: str | None = None,
    max_depth: int = 5,
    bins: int = 32,
    min_gain: float = 0.0,
) -> TreeModel:
    """Gini tree for a 0/1 label; nulls and NaN are missing values, a category unseen in a node goes right.

    Rows without a label or weight are left out.
    """
    require_columns(df, [*numeric, *categorical, label, *([weight] if weight else [])])
    features = [*numeric, *categorical]
    edges = cut_points(df, numeric, bins)

    def bin_of(c: str) -> Column:
        x = _number(c)
        over = [F.when(x > e, 1).otherwise(0) for e in edges[c]]
        return F.when(x.isNotNull(), reduce(lambda a, b: a + b, over, F.lit(0))).cast("string")

    rows = df.select(
        *[bin_of(c).alias(f"f{i}") for i, c in enumerate(numeric)],
        *[F.col(c).cast("string").alias(f"f{len(numeric) + i}") for i, c in enumerate(categorical)],
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    ).filter("y IS NOT NULL AND w > 0")
    # rows alike in bins and label count as one, so that levels read each combination once
    alike = [f"f{i}" for i in range(len(features))]
    rows = staged(rows.groupBy(*alike, "y").agg(F.sum("w").alias("w")), "tree")
    total = rows.agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).first()
    if not total["w"]:
        raise ValueError("no rows to fit")
    rates, splits, binned = {1: total["wy"] / total["w"]}, {}, {}
    open_ = [1]
    for _ in range(max_depth):

        def place(k: int) -> Column:
            if k not in binned:
                return F.lit(k if k in open_ else None).cast("int")
            i, left, default = binned[k]
            absent = F.col(f"f{i}").isNull()
            side = F.when(absent, F.lit(default)).otherwise(F.col(f"f{i}").isin(left))
            return F.when(side, place(2 * k)).otherwise(place(2 * k + 1))

        found = best_splits(_histograms(rows, place(1), features), len(numeric)).collect()
        open_ = []
        for r in found:
            if r["gain"] <= min_gain:
                continue
            c, left = features[r["feature"]], r["left_bins"]
            is_number = r["feature"] < len(numeric)
            splits[r["node"]] = Split(
                c,
                edges[c][max(int(b) for b in left)] if is_number else None,
                None if is_number else tuple(sorted(left)),
                r["default_left"], r["gain"], r["left_w"], r["right_w"],
            )
            if is_number:  # bins that the node itself has not seen lie left as well
                left = [str(b) for b in range(max(int(b) for b in left) + 1)]
            binned[r["node"]] = (r["feature"], left, r["default_left"])
            for child, side in ((2 * r["node"], "left"), (2 * r["node"] + 1, "right")):
                rates[child] = r[f"{side}_wy"] / r[f"{side}_w"] if r[f"{side}_w"] else rates[r["node"]]
            open_ += [2 * r["node"], 2 * r["node"] + 1]
        if not open_:
            break
    return TreeModel(splits, rates)
