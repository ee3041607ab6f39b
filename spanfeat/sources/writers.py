"""Stage tables, predictions, shared tables and the log of model runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, started timestamp, stage string, seconds double, metric string, value double"


def checkpoint_stage(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> DataFrame:
    """Persist a stage as parquet and return it re-read: lineage is cut, sizes are known.

    Rows are rebalanced by the partition columns: adaptive execution splits a partition
    value with very many rows over several files and merges small ones.
    """
    writer = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def save_predictions(scored: DataFrame, path: str, label: str, fmt: str = "csv") -> None:
    """Write (label, raw, probability of class 1) as CSV or parquet parts."""
    flat = scored.select(
        F.col(label).cast("double").alias("label"),
        F.col("prediction").alias("raw"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("probability"),
    )
    flat.write.mode("overwrite").format(fmt).option("header", True).save(path)


def save_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report table such as feature importances."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def publish_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Publish in the metastore for other users."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    stage: str,
    seconds: float,
    metrics: Mapping[str, float],
    started: datetime | None = None,
) -> None:
    """Append one row per metric of a model run to the runs table."""
    began = started or datetime.now()
    rows = [(run_id, began, stage, float(seconds), m, float(v)) for m, v in metrics.items()]
    spark.createDataFrame(rows, RUN_SCHEMA).write.mode("append").parquet(path)


def compare_runs(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """Runs table as one row per (run, stage) with a column per metric."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    return (
        runs.groupBy("run_id", "stage")
        .pivot("metric", list(metrics))
        .agg(F.max("value"))
        .join(runs.groupBy("run_id", "stage").agg(F.max("seconds").alias("seconds")), ["run_id", "stage"])
    )
