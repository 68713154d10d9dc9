"""The registered queries: thin contracts over the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm import (conversations, decontaminate, divergence, exact_dedup, licenses, line_dedup, oracle,
                           personal_data, piece, secret_scan, sharding, simhash, toxicity, warc)

SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public 32k piece model installed beside the libraries."""
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = [(i, 1.0) for i in range(SHARDS + 1)]
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), even[:SHARDS], even)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         "grown_shard")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, radius=4)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    page = lambda c: F.regexp_extract(c, "^urn:page:(.+)$", 1).try_cast("bigint")
    return back.select(page("page_uri").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       page("refers_to_uri").alias("refers_to"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, scorer)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(),
                                  want=("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.with_verdict(decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damaged(rows))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_sharding, op2_simhash, op3_exact_dedup, op4_line_dedup, op5_license_scan,
           op6_secret_scan, op7_warc, op8_toxicity, op9_sentencepiece, op10_decontamination,
           op11_conversations, op12_divergence, op13_personal_data)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
