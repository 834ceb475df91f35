"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sqlloom.llm import binary_index, cover_tree, curve_packing, decontaminate, jaccard_join, language_crf, license_scan, line_dedup, prefix_trie, pu_quality, quotations, sharding, token_alignment
from sqlloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 8


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_binary_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_index.id_records(table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.languages(table(spark, sf_dir, "documents"))


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2).select(*curve_packing.DIGEST)


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.link_replies(table(spark, sf_dir, "conversations"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedupe_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.alignment(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_license_scan, op2_binary_index, op3_decontaminate, op4_language_crf, op5_curve_packing, op6_cover_tree, op7_jaccard_join, op8_quotations, op9_sharding, op10_pu_quality, op11_line_dedup, op12_token_alignment, op13_prefix_trie)}
#: Where SQL can express the operator; the others learn, tokenize, pack or compare by edits.
ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op6_cover_tree": cover_tree.oracle(),
    "op7_jaccard_join": jaccard_join.oracle(),
    "op11_line_dedup": line_dedup.oracle(),
}
