"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import byte_bpe, divergence, line_dedup, packing, quality, spelling, toxicity, url_filter, warc, weak_rules
from weir.llm.common import held_out
from weir.llm.near_documents import near_documents
from weir.llm.near_vectors import near_vectors
from weir.llm.vector_search import top_k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("ids").withColumnRenamed("id", "doc_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("row.doc_id", "text", F.size("deleted").alias("n_deleted"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("_id"), 5, 0))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("sentences").alias("n_offending"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, digests=True)
    return encoded.withColumnRenamed("id", "doc_id")


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("_id"), 4, 2))
    return quality.score_documents(docs, model).select(
        "row.doc_id", held_out(F.col("row.doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"), size=2).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages")).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"), 7)
    words = runs.select(spelling.with_misprints(F.col("run"), F.col("id"), 31).alias("word"))
    return spelling.spelling_variants(spelling.counted(words, 7, 2))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = weak_rules.judge_documents(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


TOP_K_SQL = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

QUERIES = {
    q.__name__: q
    for q in (
        op1_url_filter, op2_packing, op3_line_dedup, op4_embedding_near_dedup, op5_toxicity, op6_byte_bpe,
        op7_top_k_search, op8_quality, op9_minhash_near_dedup, op10_warc,
        op11_spelling_variants, op12_source_divergence, op13_quality_rules,
    )
}

ORACLE_SQL = {
    "op1_url_filter": url_filter.judge_sql(),
    "op3_line_dedup": line_dedup.dedup_sql(),
    "op7_top_k_search": TOP_K_SQL,
    "op10_warc": warc.WARC_SQL,
    "op12_source_divergence": divergence.DIVERGENCE_SQL,
    "op13_quality_rules": weak_rules.judge_sql(),
}
