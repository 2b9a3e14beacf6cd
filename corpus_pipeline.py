"""From raw documents to packed training sequences: five stages, each a table of its own.

Every stage reads whole texts and treats a null one as empty; it neither needs nor changes columns besides ``doc_id``,
``text`` and ``n_chars``, whatever their names, and all but the last return the columns they were given. Rows that repeat a
document, id and text, are judged alike and leave the near-copy stage once; rows with a null id are documents like any others. An empty table
stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import line_dedup, packing, quality, toxicity
from weir.llm.common import WIDE_ROWS, held_out, stored
from weir.llm.near_documents import near_documents


def both_labels(labels: DataFrame, label: str) -> DataFrame:
    """``labels``, if it has both classes: with one of them a classifier would keep everything or nothing."""
    if labels.where(F.col(label).isin(0, 1)).select(label).distinct().count() < 2:
        raise ValueError(f"documents labelled {label} 0 and 1 are needed")
    return labels


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is judged 0.5 or better. Raises if ``labels`` does not have both classes."""
    labels = both_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    if docs.isEmpty():
        return docs
    model = quality.fit(docs, labels, ~held_out(F.col("_id"), 4, 2))
    return quality.score_documents(docs, model).where("score >= 0.5").select("row.*")


def harmless_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is judged below 0.5. Raises if ``labels`` does not have both classes."""
    labels = both_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic")
    if docs.isEmpty():
        return docs
    model = toxicity.fit(docs, labels, ~held_out(F.col("_id"), 5, 0))
    return toxicity.score_documents(docs, model, spans=False).where("score < 0.5").select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more; every document stays, if only with an empty text."""
    result = line_dedup.dedup_lines(docs).select("row.*", F.col("text").alias("_deduplicated"))
    return result.withColumns({"text": F.col("_deduplicated"), "n_chars": F.length("_deduplicated").cast("long")}).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    It is the one with the smallest id. Rows that repeat id and text are one document. At this similarity of five-word shingles a
    pair stays linked up to about one changed word in 45; copies that differ by more are other documents here.
    """
    found = near_documents(docs)
    staying = found.where("stays").select(F.struct("id", "text_hash").alias("_key")).distinct()
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")).alias("_key"), F.struct("*").alias("_row"))
    return keyed.join(staying, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 4096 tokens, with their ids and places; ``packing.sequences`` joins them."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", good_documents),
    ("toxicity", harmless_documents),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: The classifiers, the signatures and the tokenizer have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name, batch_rows=WIDE_ROWS)
    return STAGES[-1][1](spark, docs, sf_dir)
