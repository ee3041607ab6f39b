"""Feature encoding, weighted classifiers, scoring and model tables on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    Imputer,
    Interaction,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The final feature set of the delay model.
DELAY_NUMERIC = (
    "DELAYS_SO_FAR",
    "MINUTES_AFTER_MIDNIGHT_ORIGIN",
    "MINUTES_AFTER_MIDNIGHT_DEST",
    "NETWORK_CONGESTION",
    "AVG_VIS_DIS_ORIGIN",
    "DEST_PR",
    "ORIGIN_PR",
    "AVG_DEW_DEG_ORIGIN",
    "CRS_ELAPSED_TIME",
    "AVG_WND_SPEED_ORIGIN",
    "AVG_WND_SPEED_DEST",
)
DELAY_CATEGORICAL = ("QUARTER", "IS_EARLY_MORNING_FLIGHT", "DEP_HOUR_BIN", "ARR_HOUR_BIN")


def encoder_stages(
    num: Sequence[str],
    cat: Sequence[str],
    features: str = "features",
    scale: bool = False,
    interactions: Sequence[tuple[str, str]] = (),
) -> list:
    """Index and one-hot encode categories, join numeric columns, optionally standardise.

    Unseen or missing categories get their own slot; missing numbers stay NaN-free only
    if they were imputed before, otherwise the row is rejected with an error.
    """
    stages: list = []
    if cat:
        stages.append(
            StringIndexer(
                inputCols=list(cat),
                outputCols=[f"{c}_index" for c in cat],
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in cat],
                outputCols=[f"{c}_vec" for c in cat],
                handleInvalid="keep",
                dropLast=True,
            )
        )
    crossed = []
    for a, b in interactions:
        crossed.append(f"{a}_x_{b}")
        stages.append(Interaction(inputCols=[a, b], outputCol=crossed[-1]))
    target = "_unscaled" if scale else features
    stages.append(
        VectorAssembler(
            inputCols=[*num, *crossed, *[f"{c}_vec" for c in cat]],
            outputCol=target,
            handleInvalid="error",
        )
    )
    if scale:
        stages.append(
            StandardScaler(inputCol=target, outputCol=features, withMean=True, withStd=True)
        )
    return stages


def build_pipeline(
    num: Sequence[str],
    cat: Sequence[str],
    estimator: Estimator | None = None,
    scale: bool = False,
    interactions: Sequence[tuple[str, str]] = (),
) -> Pipeline:
    """Encoding stages and, when given, a classifier; feature lists are the configuration."""
    stages = encoder_stages(num, cat, scale=scale, interactions=interactions)
    return Pipeline(stages=[*stages, estimator] if estimator else stages)


def logistic(label: str, weight: str | None = None, **params) -> LogisticRegression:
    """Logistic regression with an optional row weight."""
    model = LogisticRegression(labelCol=label, featuresCol="features", **params)
    return model.setWeightCol(weight) if weight else model


def forest(label: str, weight: str | None = None, seed: int = 7, **params) -> RandomForestClassifier:
    """Random forest with a fixed seed and an optional row weight."""
    model = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    return model.setWeightCol(weight) if weight else model


def tree_with_missing(
    num: Sequence[str], cat: Sequence[str], label: str, seed: int = 7, **params
) -> Pipeline:
    """Gini decision tree that accepts missing numbers.

    Missing numbers are replaced by the column's mean and marked by an extra 0/1 column
    (see ``mark_missing``), so the tree can still split on their absence.
    """
    imputed = Imputer(inputCols=list(num), outputCols=[f"{c}_filled" for c in num])
    indexed = StringIndexer(
        inputCols=list(cat), outputCols=[f"{c}_index" for c in cat], handleInvalid="keep"
    )
    joined = VectorAssembler(
        inputCols=[
            *[f"{c}_index" for c in cat],
            *[f"{c}_filled" for c in num],
            *[f"{c}_absent" for c in num],
        ],
        outputCol="features",
    )
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    return Pipeline(stages=[imputed, *([indexed] if cat else []), joined, tree])


def mark_missing(df: DataFrame, num: Sequence[str]) -> DataFrame:
    """Numeric columns as doubles with a 0/1 column for absence."""
    return df.withColumns(
        {f"{c}_absent": F.col(c).isNull().cast("double") for c in num}
        | {c: F.col(c).cast("double") for c in num}
    )


def score(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Prediction and class probabilities as plain columns."""
    return model.transform(df).select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probabilities"),
    )


def areas(scored: DataFrame, label: str, raw: str = "rawPrediction") -> dict[str, float]:
    """Areas under the ROC and precision-recall curves (binned by Spark ML)."""
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw)
    return {
        "auc_roc": judge.evaluate(scored, {judge.metricName: "areaUnderROC"}),
        "auc_pr": judge.evaluate(scored, {judge.metricName: "areaUnderPR"}),
    }


def slot_names(encoded: DataFrame, features: str = "features") -> list[str]:
    """Names of the feature vector's slots, from the column's metadata."""
    attrs = encoded.schema[features].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    return [slots[i] for i in sorted(slots)]


def _source_column(slot: str, inputs: Sequence[str]) -> str:
    fits = [c for c in inputs if slot == c or slot.startswith(f"{c}_vec_")]
    return max(fits, key=len) if fits else slot


def importance_table(
    model: PipelineModel, encoded: DataFrame, inputs: Sequence[str], groups: Mapping[str, str] | None = None
) -> DataFrame:
    """Importances of the last stage, added up per input column, with shares per group.

    ``groups`` names the group of a column (e.g. "weather"). The table has one row per
    input column, so its size is set by the feature list.
    """
    values = model.stages[-1].featureImportances.toArray()
    sums: dict[str, float] = dict.fromkeys(inputs, 0.0)
    for slot, value in zip(slot_names(encoded), values, strict=True):
        column = _source_column(slot, inputs)
        sums[column] = sums.get(column, 0.0) + float(value)
    rows = [(c, (groups or {}).get(c, "other"), v) for c, v in sums.items()]
    return encoded.sparkSession.createDataFrame(
        rows, "feature string, feature_group string, importance double"
    )


def group_shares(importances: DataFrame, top: int) -> DataFrame:
    """Number of features and importance share of each group among the top ones."""
    best = importances.orderBy(F.desc("importance"), "feature").limit(top)
    total = best.agg(F.sum("importance").alias("_all"))
    return (
        best.groupBy("feature_group")
        .agg(F.count("*").alias("n"), F.sum("importance").alias("_sum"))
        .join(F.broadcast(total))
        .select("feature_group", "n", F.try_divide("_sum", "_all").alias("share"))
    )


def coefficients_table(model: PipelineModel, encoded: DataFrame) -> DataFrame:
    """Coefficients of the last stage as (slot, coefficient), with the intercept."""
    last = model.stages[-1]
    rows = [
        (name, float(v))
        for name, v in zip(slot_names(encoded), last.coefficients.toArray(), strict=True)
    ]
    return encoded.sparkSession.createDataFrame(
        [("(intercept)", float(last.intercept)), *rows], "slot string, coefficient double"
    )


def time_series_search(
    folds: DataFrame,
    make: Callable[..., Pipeline],
    grid: Mapping[str, Sequence],
    label: str,
    fold: str = "fold",
    role: str = "role",
) -> DataFrame:
    """Try every grid point on time-ordered folds; one row per (fold, parameters).

    ``folds`` comes from ``rolling_splits``; ``make`` builds an untrained pipeline from
    keyword parameters. The loop runs over a small literal grid, the work of each step
    is distributed.
    """
    names = sorted(grid)
    years = sorted(r[0] for r in folds.select(fold).distinct().collect())
    rows = []
    for year in years:
        part = folds.filter(F.col(fold) == year)
        train = part.filter(F.col(role) == "train").persist()
        test = part.filter(F.col(role) == "test").persist()
        for values in product(*[grid[n] for n in names]):
            params = dict(zip(names, values, strict=True))
            found = areas(make(**params).fit(train).transform(test), label)
            rows.append((int(year), str(params), found["auc_roc"], found["auc_pr"]))
        train.unpersist()
        test.unpersist()
    return folds.sparkSession.createDataFrame(
        rows, "fold int, params string, auc_roc double, auc_pr double"
    )
