"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table and derives the
columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import (chosen_path, chunk_tokens, decontaminate, exact_dedup, hard_negatives, line_dedup, ngram_join,
                        packing, prefix_trie, quality, secret_scan, substring_dedup, token_counts, token_files)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_documents(spark, sf_dir), with_text=False)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_shared_lines(_documents(spark, sf_dir), with_text=False)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(_documents(spark, sf_dir))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), chunk_tokens.vocabulary("byte_bpe_50k.json"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_documents(_documents(spark, sf_dir), chunk_tokens.vocabulary("word_bpe_49k.json"))
    return token_files.read_files(manifest)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_documents(spark, sf_dir)))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), chunk_tokens.vocabulary("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.predictions(docs, model)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.summary(decontaminate.find_overlaps(_documents(spark, sf_dir), benchmark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_line_dedup, op3_exact_dedup, op4_ngram_join,
                                   op5_best_fit_packing, op6_secret_scan, op7_token_files, op8_token_counts, op9_quality,
                                   op10_decontamination, op11_hard_negatives, op12_chosen_path, op13_prefix_trie)}
