"""Registered queries of the numbered operators, over the whole tables and with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import conversation_trie, decontamination, hard_negatives, html_text, license_scan, line_dedup, packing, pii, quality_rules, secret_scan, simhash, token_counts, warc

MAX_TOKENS = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    n_hit = decontamination.hit_words(F.col("match_spans"))
    return found.select(
        "doc_id", F.col("match_n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("match_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("match_items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(F.col("match_n_words"), n_hit).alias("contaminated"))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(_table(spark, sf_dir, "documents"), pii.session_key(spark))
    of = lambda kind: lambda r: r["kind"] == kind
    counts = [F.size(F.filter("replaced", of(kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return out.select("doc_id", "text", *counts)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.quality_rules(documents).drop("text", "source")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), capacity=MAX_TOKENS)


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.records(_table(spark, sf_dir, "pages"), "page_id", "url", "html")
    chunks = warc.read_warc(warc.write_warc(rows))
    return chunks.where("last").select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    count = lambda spans, test: F.size(F.filter(spans, test)).cast("bigint")
    of = lambda k: lambda s: s["kind"] == k
    return found.select(
        "doc_id", *[count("base", of(k)).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])],
        F.sha2(secret_scan.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
        count("spans", lambda s: s["live"]).alias("n_live"), count("spans", lambda s: ~s["live"]).alias("n_copied"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_negatives(_table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination,
    op2_pii_pseudonyms,
    op3_quality_rules,
    op4_packing,
    op5_warc_round_trip,
    op6_html_text,
    op7_token_counts,
    op8_secret_scan,
    op9_simhash_near_dedup,
    op10_line_dedup,
    op11_license_scan,
    op12_hard_negatives,
    op13_conversation_trie,
)}
