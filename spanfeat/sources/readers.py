"""Tables from files, the metastore and local rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.packed import parse_fixed_width


def load_table(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None) -> DataFrame:
    """Parquet file, directory or glob; an explicit schema skips the footer pass."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def load_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, spread: int | None = None
) -> DataFrame:
    """CSV with a header; without a schema every column is text.

    A gzipped file is read by one task; ``spread`` redistributes its rows afterwards.
    """
    reader = spark.read.option("header", True)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df.repartition(spread) if spread else df


def load_fixed_width(
    spark: SparkSession, path: str, layout: Sequence[tuple[str, int, int, str]], comment: str = "!"
) -> DataFrame:
    """Fixed-width text file; blank lines and comment lines are skipped."""
    lines = spark.read.text(path).filter(
        (F.trim("value") != "") & ~F.col("value").startswith(comment)
    )
    return parse_fixed_width(lines, layout)


def head_of_table(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First k rows by an order key, so that the result is defined."""
    return df.orderBy(*order).limit(k)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Saved predictions (label, raw, probability); stays distributed."""
    return load_csv(spark, path, "label double, raw double, probability double")


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Short literal table."""
    return spark.createDataFrame(list(rows), schema)


def query_view(spark: SparkSession, views: dict[str, DataFrame], sql: str, **args) -> DataFrame:
    """Register frames under names and run SQL with named arguments."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args)


def scan_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; the counts read no column data."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out
