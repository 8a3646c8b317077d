"""Exact token length histogram of a corpus.

Documents are encoded by a public tokenizer and folded to one row per encoded
length. Suffix sums over the histogram then answer totals, quantiles and truncated
totals for every context limit without touching the documents again.

A null text counts as empty (length 0). Repeated rows count each time. An empty
table gives an empty curve. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodica.llm.common import staged, text_of

_ENCODERS: dict = {}


def encoder(path: str, pattern: str):
    """The byte-level BPE whose ranks lie in ``path``, loaded once per worker."""
    import base64

    import tiktoken

    if path not in _ENCODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def length_histogram(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """(n_tokens, documents): how many documents have each encoded length.

    ``ranks`` names a rank file that every executor has, ``pattern`` its splitter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(lengths, pa.int64())})

    lengths = docs.select(text_of(F.col(text)).alias("text")).mapInArrow(count, "n_tokens long")
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def length_curve(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """Suffix sums over a histogram, one row per length that occurs.

    * ``docs_at_least``, ``tokens_at_least``: documents of this length or more, and their tokens;
    * ``truncated_tokens``: tokens left when every document is cut at this length;
    * ``docs_within``: documents that fit (their share of all is the quantile of the length);
    * ``total_documents``, ``total_tokens``: of the corpus.

    Between two lengths that occur, nothing but the limit changes (``at_limits``).
    Sums run within blocks of ``block`` lengths and over the block totals, so no
    task holds more than a block or one row per block.
    """
    keyed = histogram.withColumn("block", F.floor(F.col("n_tokens") / block))
    tokens = F.col("n_tokens") * F.col("documents")
    falling = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = (
        keyed.groupBy("block")
        .agg(F.sum("documents").alias("d"), F.sum(tokens).alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(falling), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("t").over(falling), F.lit(0)).alias("tokens_above"),
            F.sum("d").over(every).alias("total_documents"),
            F.sum("t").over(every).alias("total_tokens"),
        )
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    at_least = F.sum("documents").over(inside) + F.col("docs_above")
    tokens_at_least = F.sum(tokens).over(inside) + F.col("tokens_above")
    return (
        keyed.join(blocks, "block")
        .withColumns({"docs_at_least": at_least, "tokens_at_least": tokens_at_least})
        .select(
            "n_tokens", "documents", "docs_at_least", "tokens_at_least",
            (F.col("total_documents") - F.col("docs_at_least") + F.col("documents")).alias("docs_within"),
            (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"))
            .alias("truncated_tokens"),
            "total_documents", "total_tokens",
        )
    )


def at_limits(curve: DataFrame, limits: DataFrame, limit: str = "context_limit") -> DataFrame:
    """Tokens kept and documents cut for each row of ``limits``: the first length at or above it decides.

    A limit above every length keeps all. Curve and limits meet in one sorted union,
    which has at most one row per length and limit.
    """
    points = curve.select(
        F.col("n_tokens").alias("at"), F.lit(None).cast("long").alias(limit),
        F.struct("n_tokens", "docs_at_least", "tokens_at_least", "total_tokens").alias("point"),
    )
    asked = limits.select(
        F.col(limit).cast("long").alias("at"), F.col(limit).cast("long").alias(limit),
        F.lit(None).cast(points.schema["point"].dataType).alias("point"),
    ).distinct()
    following = Window.orderBy(F.desc("at"), F.desc_nulls_last("point")).rowsBetween(Window.unboundedPreceding, 0)
    total = F.max("point.total_tokens").over(Window.partitionBy())
    return (
        points.unionByName(asked)
        .withColumns({"next": F.last("point", ignorenulls=True).over(following), "total": total})
        .where(F.col(limit).isNotNull())
        .select(
            limit,
            F.when(F.col("next").isNull(), F.col("total"))
            .otherwise(F.col("total") - F.col("next.tokens_at_least") + F.col(limit) * F.col("next.docs_at_least"))
            .alias("truncated_tokens"),
            F.coalesce(F.col("next.docs_at_least"), F.lit(0)).alias("docs_at_least"),
        )
    )


def count_tokens(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """The length curve of ``docs``. The histogram is written once, so texts are encoded once."""
    return length_curve(staged(length_histogram(docs, ranks, pattern, text), "lengths"))
