"""The subpackage's queries by name, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from accolade.llm import conversation_trie, filter_audit, hilbert_ann, interleave_shards, minmax_dedup, packing, piece_transducer, site_lines, source_mix, suffix_dedup, threshold_topk, token_files, toxicity
from accolade.llm.common import read
from accolade.llm.statements import SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_suffix_array_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", F.col("bytes_").alias("n_bytes"), (F.col("bytes_") - F.octet_length("kept_")).alias("n_removed"),
        F.col("spans_").alias("n_spans"), F.sha2("kept_", 256).alias("kept_sha256"),
    )


def op3_perfect_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.fresh_path(spark)
    token_files.write(read(spark, sf_dir, "documents"), path, width=2)
    return token_files.digests(token_files.lookup(spark, path))


def op4_minmax_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(read(spark, sf_dir, "embeddings"), k=20, every_nth=20, scale=64)


def op6_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return site_lines.drop_lines(docs, site="source").select(
        "doc_id", "source", F.col("lines_").alias("n_lines"), F.col("dropped_").alias("n_dropped"), "text"
    )


def op7_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op8_weighted_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_transducer.encode(read(spark, sf_dir, "documents"))


def op9_hilbert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.nearest(read(spark, sf_dir, "embeddings"), k=20, every_nth=20)


def op10_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave_shards.interleave(read(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_rollup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(*conversation_trie.rebuilt(read(spark, sf_dir, "conversations")))


def op12_budget_fitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents"))


def op13_tensor_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    named = (
        op1_factorization_machine, op2_suffix_array_spans, op3_perfect_hash_index, op4_minmax_components,
        op5_threshold_topk, op6_site_line_frequency, op7_shortest_pack_first, op8_weighted_transducer, op9_hilbert_windows, op10_stratified_interleaving,
        op11_rollup_trie, op12_budget_fitting, op13_tensor_audit,
    )
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
