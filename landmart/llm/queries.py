"""The operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from landmart.llm import byte_bpe, divergence, language_id, line_dedup, ngram_join, prefix_trie, quality_rules, secret_scan, source_mix, token_counts, top_k, toxicity, word_bpe
from landmart.llm.common import configure, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    found = {
        "op1_ngram_join": lambda spark, d: ngram_join.joined(table(spark, d, "documents")),
        "op2_top_k": lambda spark, d: top_k.digest(table(spark, d, "embeddings")),
        "op3_quality_rules": lambda spark, d: quality_rules.digest(table(spark, d, "documents")),
        "op4_toxicity": lambda spark, d: toxicity.digest(table(spark, d, "documents"), table(spark, d, "labels")),
        "op5_secret_scans": lambda spark, d: secret_scan.digest(table(spark, d, "documents")),
        "op5_secret_classes": lambda spark, d: secret_scan.classes(table(spark, d, "documents")),
        "op6_source_mix": lambda spark, d: source_mix.digest(table(spark, d, "documents")),
        "op7_language_id": lambda spark, d: language_id.digest(table(spark, d, "documents")),
        "op8_token_counts": lambda spark, d: token_counts.digest(table(spark, d, "documents"), path, pattern),
        "op9_line_dedup": lambda spark, d: line_dedup.digest(table(spark, d, "documents")),
        "op10_byte_bpe": lambda spark, d: byte_bpe.digest(table(spark, d, "documents"), path, pattern),
        "op11_word_bpe": lambda spark, d: word_bpe.digest(table(spark, d, "documents"), public_tokenizers.path(WORD_VOCABULARY)),
        "op12_prefix_trie": lambda spark, d: prefix_trie.prefixes(table(spark, d, "conversations")),
        "op13_divergence": lambda spark, d: divergence.audit(table(spark, d, "documents")),
    }

    def configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, d: query(configure(spark), d)

    return {name: configured(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.ORACLE_SQL,
        "op2_top_k": top_k.ORACLE_SQL,
        "op3_quality_rules": quality_rules.ORACLE_SQL,
        "op5_secret_scans": secret_scan.ORACLE_SQL,
        "op5_secret_classes": secret_scan.CLASSES_SQL,
        "op6_source_mix": source_mix.ORACLE_SQL,
        "op9_line_dedup": line_dedup.ORACLE_SQL,
        "op12_prefix_trie": prefix_trie.ORACLE_SQL,
        "op13_divergence": divergence.ORACLE_SQL,
    }
