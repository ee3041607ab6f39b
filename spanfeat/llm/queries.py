"""Registered queries of the text operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanfeat.llm import fill_middle
from spanfeat.llm import line_dedup as lines
from spanfeat.llm.decontaminate import leaks
from spanfeat.llm.hilbert_pack import pack
from spanfeat.llm.huffman_ids import id_archive_round_trip
from spanfeat.llm.licenses import license_scan
from spanfeat.llm.merkle import fingerprints
from spanfeat.llm.pseudonyms import pseudonymize
from spanfeat.llm.simhash_vp import simhash_groups
from spanfeat.llm.suffix_dedup import suffix_dedup
from spanfeat.llm.toxicity import toxicity
from spanfeat.llm.warc import archive_round_trip
from spanfeat.llm.whitening import whiten


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark, folder):
    return suffix_dedup(table(spark, folder, "documents")).drop("kept")


def op2_decontaminate(spark, folder):
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_license_scan(spark, folder):
    return license_scan(table(spark, folder, "documents"))


def op4_toxicity(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_packing(spark, folder):
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op6_warc(spark, folder):
    return archive_round_trip(table(spark, folder, "pages")).drop("url", "payload")


def op7_merkle(spark, folder):
    return fingerprints(table(spark, folder, "documents"))


def op8_line_dedup(spark, folder):
    return lines.line_dedup(table(spark, folder, "documents"))


def op9_pseudonyms(spark, folder):
    return pseudonymize(table(spark, folder, "documents"), "pseudonym-key")


def op10_simhash(spark, folder):
    return simhash_groups(table(spark, folder, "documents")).drop("fp")


def op11_fill_middle(spark, folder):
    return fill_middle.digests(table(spark, folder, "documents"))


def op12_whitening(spark, folder):
    return whiten(table(spark, folder, "embeddings"))


def op13_huffman_ids(spark, folder):
    return id_archive_round_trip(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_decontaminate, op3_license_scan, op4_toxicity, op5_packing,
        op6_warc, op7_merkle, op8_line_dedup, op9_pseudonyms, op10_simhash,
        op11_fill_middle, op12_whitening, op13_huffman_ids,
    )
}
SQL = {"op8_line_dedup": lines.SQL, "op11_fill_middle": fill_middle.SQL}
