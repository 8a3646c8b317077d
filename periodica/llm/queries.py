"""The registered query of every operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm import (
    byte_bpe, clustering, decontaminate, fingerprints, hard_negatives, kneser_ney, line_dedup, minhash, packing, secrets,
    token_counts, toxicity, warc,
)
from periodica.llm.common import crc_remainder_column, new_folder, table
from periodica.llm.oracles import ORACLES


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages archived with content-addressed payloads and read back."""
    archive = new_folder(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.record_facts(warc.read_archive(spark, archive)).withColumnRenamed("record_id", "page_id")


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """A new ledger brought up to date with all documents."""
    ledger = secrets.Ledger(spark, new_folder(spark, "ledger"))
    ledger.update(table(spark, folder, "documents"))
    found = ledger.by_path()

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["place"] == kind)).cast("long")

    text = secrets.span_text(F.col("spans"))
    return found.select(
        F.col("path").alias("doc_id"), count(1).alias("n_assign"), count(2).alias("n_access"), count(3).alias("n_hex"),
        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"),
    )


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by the model of nine tenths of them."""
    return kneser_ney.train_and_score(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows found in all documents."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by a classifier learned from two thirds of them."""
    docs = table(spark, folder, "documents")
    held_out = crc_remainder_column(F.col("doc_id"), 3) == 1
    classifier = toxicity.train(docs, table(spark, folder, "labels"), ~held_out)
    return toxicity.score(docs, classifier, held_out)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The length curve of all documents under a byte-level vocabulary."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.count_tokens(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that ten or more sources share."""
    cleaned = line_dedup.remove_shared_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"), min(blocks, 1 << 16))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents linked by their word pairs."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=2, percent=80).drop("text_key")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    return packing.pack_documents(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    rows = hard_negatives.relabelled(hard_negatives.integer_rows(table(spark, folder, "embeddings")))
    return hard_negatives.hard_negatives(rows)


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds."""
    return clustering.with_inertia(*clustering.cluster_vectors(table(spark, folder, "embeddings")))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded by a byte-level vocabulary and decoded again."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(table(spark, folder, "documents"), ranks, pattern), ranks)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc, op2_secrets, op3_lm_score, op4_decontaminate, op5_toxicity, op6_token_counts, op7_line_dedup,
        op8_fingerprints, op9_near_dedup, op10_packing, op11_hard_negatives, op12_clusters, op13_byte_bpe,
    )
}

__all__ = ["ORACLES", "QUERIES"]
