"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanfeat.llm.common import without
from spanfeat.llm.decontaminate import decontaminate
from spanfeat.llm.hilbert_pack import pack
from spanfeat.llm.line_dedup import line_dedup
from spanfeat.llm.near_dup import keep_first
from spanfeat.llm.queries import table, tokenizer_path
from spanfeat.llm.toxicity import toxicity
from spanfeat.session import scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.7 or more go. Rows of one doc_id go together."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.filter("predicted = 1").select("doc_id"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go; documents stay, empty ones too."""
    return line_dedup(docs).drop("lines_removed")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five words, Jaccard 0.8) stays: that with the smallest doc_id."""
    return keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, packed into sequences."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", keep_one),
    ("decontamination", drop_leaks),
    ("packing", pack_all),
]

# Model fits, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    root = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
