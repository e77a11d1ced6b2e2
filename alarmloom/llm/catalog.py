"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alarmloom.llm import (
    conversation_trie,
    decontamination,
    fingerprints,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    quality,
    resampling,
    rule_forest,
    secret_scan,
    token_counts,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; its package is needed by two queries only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.toxicity(docs, labels)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_join.ngram_join(docs, words=4, percent=85)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.best_fit_packing(docs, vocabulary("word_bpe_49k.json"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.decontamination_report(docs, items)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.rate(docs.select("doc_id", "text"), quality.graded(labels)).select(
        "doc_id", "expected_grade", "tail", "kept"
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resampling_report(docs, items)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return rule_forest.rule_report(docs, labels)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_fingerprints": op9_fingerprints,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE = {
    "op3_ngram_join": ngram_join.join_sql(4, 85),
    "op6_decontamination": decontamination.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_importance_resampling": resampling.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
