"""From documents to packed training sequences in five stages.

Every stage works on all rows that its predecessor kept, and its decisions take
effect: toxic documents go, lines that many sites share go (and documents that held
nothing else), one document of each group of near duplicates stays, documents
contaminated by benchmark items go, and what is left is packed. All stages but the
last return the columns of documents. Empty tables, nulls and repeated rows are
treated as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm import decontaminate, line_dedup, minhash, packing, toxicity
from periodica.llm.common import crc_remainder_column, importable, staged, table, without

MIN_SITES = 10
SEQUENCE = 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic. It learns from two thirds of the labelled ids."""
    trainable = crc_remainder_column(F.col("doc_id"), 3) != 1
    classifier = toxicity.train(docs, table(spark, sf_dir, "labels"), trainable)
    return toxicity.without_toxic(docs, classifier)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those of which nothing but blank lines is left go."""
    cleaned = line_dedup.remove_shared_lines(docs, MIN_SITES)
    left = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike("[^ \t\r\n]"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return left.select(*(
        F.when(F.col("n_removed") == 0, F.col("row")[c]).otherwise(changed[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates, by runs of five words at 0.8."""
    importable(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    return without(docs, found.where(~F.col("kept")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all remaining documents' pieces in sequences."""
    importable(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]

#: Neither the classifier nor the tokenizer can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
