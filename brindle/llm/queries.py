"""The registered query of each operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from brindle.llm import (
    byte_bpe,
    code_compression,
    decontamination,
    filter_audit,
    html_extraction,
    jaccard_join,
    license_bank,
    license_scan,
    line_dedup,
    oracles,
    pii,
    quality_rules,
    suffix_dedup,
    token_counts,
    url_filter,
)
from brindle.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


#: The vocabulary file that the byte-level BPE query reads.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


#: Rules (verdict, host, path) of the URL query; names, their numbered mirrors and the domains they stand under make its block list. Fixed values.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
URL_BLOCKED = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
URL_DOMAINS = ("example.com", "example.net", "example.org")
URL_MIRRORS = 1000


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN))


def url_block_list(spark: SparkSession) -> DataFrame:
    """Every blocked name and its numbered mirrors ("spam-farm7") under each domain."""
    each = lambda values: F.explode(F.array(*map(F.lit, values)))
    numbers = spark.range(URL_MIRRORS).select(F.when(F.col("id") > 0, F.col("id").cast("string")).otherwise("").alias("n"))
    names = numbers.select("n", each(URL_BLOCKED).alias("name")).select("n", "name", each(URL_DOMAINS).alias("of"))
    return names.select(F.concat("name", "n", F.lit("."), "of").alias("domain"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, url_block_list(spark)).select("page_id", "host", "path", "rule", "verdict")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.counted(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "n_pretokens", "n_tokens", "n_unknown")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.deduplicated(docs)
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select(
        "doc_id", "n_units", "n_removed", "n_shared_words", "passage_words", (F.col("passage_words") > line_dedup.PASSAGE).alias("has_passage"),
        spans("removed").alias("removed_spans"), spans("kept").alias("kept_spans"), "text",
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.scan(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"), pii.listed("found").alias("spans"),
        F.size("found").cast("bigint").alias("n_spans"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs, license_bank.bank()).select(
        "doc_id", F.size("licenses").cast("bigint").alias("n_licenses"), F.array_join("licenses.license", ",").alias("licenses")
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_compression.compressed(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.deduplicated(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    every = (
        op1_html_extraction,
        op2_byte_bpe,
        op3_url_filter,
        op4_token_counts,
        op5_line_dedup,
        op6_decontamination,
        op7_jaccard_join,
        op8_pii,
        op9_license_scan,
        op10_quality_rules,
        op11_code_compression,
        op12_suffix_dedup,
        op13_filter_audit,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    """For queries that SQL can express; tests hold the others against brute force."""
    return {
        "op1_html_extraction": oracles.HTML_EXTRACTION,
        "op3_url_filter": oracles.url_filter(URL_RULES, URL_BLOCKED, URL_DOMAINS, URL_MIRRORS),
        "op5_line_dedup": oracles.LINE_DEDUP,
        "op6_decontamination": oracles.DECONTAMINATION,
        "op7_jaccard_join": oracles.JACCARD_JOIN,
        "op11_code_compression": oracles.code_compression(),
        "op12_suffix_dedup": oracles.SUFFIX_DEDUP,
        "op13_filter_audit": oracles.FILTER_AUDIT,
        "op9_license_scan": oracles.license_bank_scan(license_bank.bank()),
    }
