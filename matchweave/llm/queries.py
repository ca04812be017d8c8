"""The registered queries: each operator over its whole table, with the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.llm import crf, decontaminate, fm_dedup, html_main, phrases, pieces, pii, rules, simhash, suffix_dedup, token_counts, toxicity, va_clusters
from matchweave.llm.common import table


def op1_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))


def op4_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op5_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items", "text_hash")


def op2_line_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_strings(table(spark, sf_dir, "documents")).drop("spans")


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("passages")


def op9_bootstrapped_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op10_rank_synchronous_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op11_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_shard_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("spans")


def op13_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.clusters(table(spark, sf_dir, "embeddings"))


def rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.ablation(rules.ledger(table(spark, sf_dir, "documents")))


QUERIES = {name: make for name, make in globals().items() if name.startswith(("op", "rule_"))}
