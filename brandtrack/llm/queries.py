"""The operators as queries over the sample tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format,
    decontamination,
    hard_negatives,
    line_dedup,
    mixing,
    ngram_join,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    token_counts,
    wrapper_extract,
)
from .tables import read_table

def vocabulary(name: str) -> str:
    """A file of the public vocabularies that are installed beside the libraries; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects, alone and with others, from one ledger of all documents."""
    return quality_rules.ablations(quality_rules.ledger(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op5_extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper_extract.digest(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return decontamination.digest(docs, read_table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_classifier.digest(docs, read_table(spark, sf_dir, "labels"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(read_table(spark, sf_dir, "conversations"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_ngram_join": op2_ngram_join,
        "op3_quality_rules": op3_quality_rules,
        "op4_mix_sources": op4_mix_sources,
        "op5_extract_html": op5_extract_html,
        "op6_decontaminate": op6_decontaminate,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_chat_format": op8_chat_format,
        "op9_shards": op9_shards,
        "op10_secret_scan": op10_secret_scan,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_line_dedup": op12_line_dedup,
        "op13_prefix_trie": op13_prefix_trie,
        "quality_ablations": quality_ablations,
    }


def oracle_sql() -> dict[str, str]:
    from . import check_sql

    return dict(check_sql.CHECK_SQL)
