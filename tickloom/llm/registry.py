"""Registered queries of the corpus operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontamination, hard_negatives, lattice_dedup, line_dedup, near_dedup, packing, quality, sharding, source_audit, substring_dedup
from tickloom.llm import token_file, url_filter, warc
from tickloom.llm.common import read_table
from tickloom.llm.sharding_sql import shard_sql
from tickloom.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]

#: Fixed values of the URL query.
RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive_records(warc.responses_of(read_table(spark, sf_dir, "pages")))
    return records.withColumn("page_id", F.col("source_id").cast("long")).drop("source_id")


def op2_grouping_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, special=True)


def op3_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    names = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", names, "contaminated")


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), RULES).drop("p_block")


def op5_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("stratum")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "token-files")
    token_file.write_token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, folder, special=True)
    return token_file.read_documents(spark, folder)


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(hard_negatives.relabelled(read_table(spark, sf_dir, "embeddings")))


def op12_lattice_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(read_table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    operators = [
        op1_warc_derivatives,
        op2_grouping_packing,
        op3_benchmark_overlaps,
        op4_url_verdicts,
        op5_risk_controlled_rules,
        op6_line_dedup,
        op7_near_duplicates,
        op8_substring_dedup,
        op9_token_files,
        op10_feistel_shards,
        op11_hard_negatives,
        op12_lattice_duplicates,
        op13_source_divergence,
    ]
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    given = {
        "op3_benchmark_overlaps": decontamination.OVERLAP_SQL,
        "op6_line_dedup": line_dedup.LINE_SQL,
        "op8_substring_dedup": substring_dedup.REPEAT_SQL,
        "op10_feistel_shards": shard_sql(),
        "op11_hard_negatives": hard_negatives.HARD_NEGATIVE_SQL,
        "op13_source_divergence": source_audit.DIVERGENCE_SQL,
    }
    return given | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
