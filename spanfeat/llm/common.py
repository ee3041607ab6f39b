"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.session import scratch, staged


def text_rows(df: DataFrame, fn: Callable[..., Iterator[tuple]], cols: list[str], schema: str) -> DataFrame:
    """Flat-map rows through ``fn(*values)``, which yields output tuples; Arrow batches both ways.

    Output is cut into batches of a few thousand rows, so a long text does not make one huge batch.
    """
    spark = df.sparkSession
    target = spark.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)

        def pack(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in cols)):
                for made in fn(*row):
                    out.append(made)
                    if len(out) >= 4000:
                        yield pack(out)
                        out = []
            if out:
                yield pack(out)

    return df.select(*cols).mapInArrow(run, schema)


def row_key(*cols: str):
    """64-bit key of a row's identity; rows that agree in these columns are interchangeable."""
    return F.xxhash64(*cols)


def release(*frames: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in frames:
        files = df.inputFiles()
        if not files:
            continue
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged_tight(df: DataFrame, label: str) -> DataFrame:
    """Like ``staged``, with Zstandard: for wide binary columns that are read back once or twice."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in the one column of ``bad``; null counts as a value."""
    name = f"bad_{uuid.uuid4().hex[:12]}"
    # staged, so that the planner sees how few they are and need not shuffle the texts
    gone = staged(bad.toDF(name).distinct(), "gone")
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")


def shielded(docs: DataFrame, own: list[str], made: list[str], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fn(docs)`` with all columns but ``own`` under generated names, so that none can clash.

    ``made`` are the columns that ``fn`` adds at the end; columns of ``docs`` with such names
    are replaced by them.
    """
    tag = uuid.uuid4().hex[:12]
    others = [c for c in docs.columns if c not in own and c not in made]
    names = {c: f"x{i}_{tag}" for i, c in enumerate(others)}
    out = fn(docs.drop(*[c for c in made if c in docs.columns and c not in own]).withColumnsRenamed(names))
    return out.withColumnsRenamed({name: c for c, name in names.items()})
