"""Registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import anchortree, crosstok, decontam, eftrie, fuzzylines, htmltree, oddsketch, outliers, packing, rans, sharding, suffixdedup, toxicity
from sheaf.llm.common import documents, table
from sheaf.llm.oracle import ORACLE
from sheaf.llm.tokens import default_tokenizer_path

SHARDS = 24


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf), table(spark, sf, "labels"))


def op2_rans(spark: SparkSession, sf: str) -> DataFrame:
    return rans.token_digest(documents(spark, sf), default_tokenizer_path(), end_id=2)


def op3_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.judge(documents(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op4_ef_trie(spark: SparkSession, sf: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return eftrie.score_documents(documents(spark, sf), held)


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf), default_tokenizer_path(), end_id=0, capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = fuzzylines.dedup_lines(documents(spark, sf).select("doc_id", "text"), similarity=0.9)
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("n_chars"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op7_html_tree(spark: SparkSession, sf: str) -> DataFrame:
    return htmltree.extract(table(spark, sf, "pages"))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_by_size(documents(spark, sf), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_odd_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return oddsketch.near_duplicates(documents(spark, sf), threshold=0.85)


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf), table(spark, sf, "benchmark"), width=10)


def op11_anchor_tree(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return anchortree.hard_negatives(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_induced_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixdedup.removal_report(documents(spark, sf), width=400)


def op13_crosstok(spark: SparkSession, sf: str) -> DataFrame:
    return crosstok.alignment_report(documents(spark, sf)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("op") and callable(fn)
}
__all__ = ["ORACLE", "QUERIES"]
