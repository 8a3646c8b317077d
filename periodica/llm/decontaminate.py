"""Exact occurrences of benchmark windows in documents.

A window is ``WINDOW`` consecutive words of an item, or the whole item if it has
fewer words. Windows and documents are joined as sets of word shingles by prefix
filtering: a document that contains a window contains all its shingles, so the
necessary prefix is one shingle, and the rarest one over all documents is taken.
Documents give out the places of those shingles only; a place that meets a window
must leave room for it on both sides (positional bounds), in a document that is long
enough (length bound), and the words there must equal the window's.

Shingle hashes only find candidates, equality is tested on words. The filter that
each task holds is a bitmap of a fixed ``2**BITS`` bits, whatever the benchmark's
size; everything else is joined by shuffles.

Null texts have no words. A null item id marks words as hit but is not listed.
Items of equal text share their windows. Rows that repeat a document are documents
of their own. Empty tables give no hits, or no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodica.llm.common import alnum_words, staged, text_key

WINDOW = 13
#: Words per shingle; windows of fewer words are one shingle.
SHINGLE = 3
#: The bitmap has 2**BITS bits, 8 MB.
BITS = 26
#: Factors of the words' hashes in a shingle's hash.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, from the words' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed = words[:n] * _FACTORS[0]
    for i in range(1, size):
        mixed = mixed + words[i : n + i] * _FACTORS[i]
    mixed ^= mixed >> np.uint64(32)
    return (mixed * _FACTORS[0]).view(np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, body, n, shingles): the windows of every item, ``body`` joined by spaces."""
    kind = benchmark.schema[item_id].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, bodies, sizes, shingles = [], [], [], []
            for i, text_value in enumerate(batch.column(1).to_pylist()):
                words = alnum_words(text_value)
                hashes = word_hashes(words)
                n = min(WINDOW, len(words))
                for low in range(len(words) - n + 1 if n else 0):
                    take.append(i)
                    bodies.append(b" ".join(words[low : low + n]).decode("utf-8", "surrogatepass"))
                    sizes.append(n)
                    shingles.append(shingle_hashes(hashes[low : low + n], min(SHINGLE, n)).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(take, pa.int64())), pa.array(bodies, pa.string()),
                 pa.array(sizes, pa.int32()), pa.array(shingles, pa.list_(pa.int64()))],
                names=["item_id", "body", "n", "shingles"],
            )

    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, f"item_id {kind.simpleString()}, body string, n int, shingles array<long>")


def bitmap(hashes: DataFrame) -> bytes:
    """A bitmap of the low ``BITS`` bits of ``hashes.shingle``: at most 2**BITS / 8 bytes come back."""
    place = F.col("shingle").bitwiseAND((1 << BITS) - 1)
    parts = (
        hashes.select((place + 1).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    out = bytearray((1 << BITS) // 8)
    for bucket, bits in parts.collect():
        at = (bucket - 1) * len(bits)
        out[at : at + len(bits)] = bits
    return bytes(out)


def _places(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = hashes & ((1 << BITS) - 1)
    return np.flatnonzero((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1)


def shingle_counts(docs: DataFrame, shared, sizes: list[int], text: str) -> DataFrame:
    """(shingle, places): how often each shingle of the bitmap occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for text_value in batch.column(0):
                words = word_hashes(alnum_words(text_value.as_py()))
                for size in sizes:
                    hashes = shingle_hashes(words, size)
                    found.append(hashes[_places(hashes, bits)])
            values, places = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(places)], names=["shingle", "places"])

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "shingle long, places long").groupBy("shingle").agg(F.sum("places").alias("places"))


def candidates(docs: DataFrame, shared, sizes: list[int], doc_id: str, text: str) -> DataFrame:
    """One row per document with its word count and the places of the bitmap's shingles.

    A place carries the words that a window around it can cover.
    """
    kind = docs.schema[doc_id].dataType

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            keys, counts, offsets, shingles, places, lows, around = [], [], [0], [], [], [], []
            for text_value in batch.column(2).to_pylist():
                words = alnum_words(text_value)
                keys.append(text_key(text_value))
                counts.append(len(words))
                hashed = word_hashes(words)
                for size in sizes:
                    before, after = (WINDOW - size, WINDOW) if size == SHINGLE else (0, size)
                    hashes = shingle_hashes(hashed, size)
                    for place in _places(hashes, bits).tolist():
                        low = max(0, place - before)
                        shingles.append(int(hashes[place]))
                        places.append(place)
                        lows.append(low)
                        around.append(b" ".join(words[low : place + after]).decode("utf-8", "surrogatepass"))
                offsets.append(len(shingles))
            struct = pa.StructArray.from_arrays(
                [pa.array(shingles, pa.int64()), pa.array(places, pa.int32()), pa.array(lows, pa.int32()),
                 pa.array(around, pa.string())],
                names=["shingle", "place", "low", "around"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)],
                names=["doc_id", "row", "text_key", "n_words", "hits"],
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        find,
        f"doc_id {kind.simpleString()}, row long, text_key binary, n_words long, "
        "hits array<struct<shingle:long,place:int,low:int,around:string>>",
    )


def find_windows(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (row, doc_id, text_key, n_words), occurrences (row, start, stop, window) and items (window, item_id)."""
    context = docs.sparkSession.sparkContext
    every = staged(item_windows(benchmark, item_id, item_text), "item-windows")
    windows = staged(
        every.groupBy("body").agg(F.any_value("n").alias("n"), F.any_value("shingles").alias("shingles"))
        .withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )
    items = every.join(windows.select("body", "window"), "body").select("window", "item_id").distinct()
    tokens = windows.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    sizes = [r[0] for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().orderBy("k").collect()]

    counts = shingle_counts(docs, context.broadcast(bitmap(tokens.select("shingle"))), sizes, text)
    rare = F.struct(F.coalesce("places", F.lit(0)).alias("places"), "offset", "shingle")
    prefix = (
        tokens.join(counts, "shingle", "left").groupBy("window").agg(F.min(rare).alias("rarest"))
        .select("window", "rarest.offset", "rarest.shingle", "rarest.places")
    )
    prefix = staged(windows.select("window", "body", "n").join(prefix, "window"), "prefixes").where("places > 0")
    shared = context.broadcast(bitmap(prefix.select("shingle")))
    found = staged(candidates(docs, shared, sizes, doc_id, text), "candidates")

    start = F.col("place") - F.col("offset")
    inside = F.slice(F.split("around", " "), start - F.col("low") + 1, F.col("n"))
    occurrences = (
        found.where(F.size("hits") > 0).select("row", "n_words", F.explode("hits").alias("hit"))
        .select("row", "n_words", "hit.*")
        .join(prefix, "shingle")
        .where((start >= F.col("low")) & (start + F.col("n") <= F.col("n_words")))
        .where(F.array_join(inside, " ") == F.col("body"))
        .select("row", start.alias("start"), (start + F.col("n")).alias("stop"), "window")
    )
    return found.select("row", "doc_id", "text_key", "n_words"), staged(occurrences, "occurrences"), items


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, **columns: str) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    A document is contaminated if at least one in ``share`` of its words lies inside
    an occurrence. ``items`` are the sorted ids, as strings.
    """
    documents, occurrences, items = find_windows(docs, benchmark, **columns)
    order = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("stop").over(order), F.lit(0))
    covered = (
        occurrences.groupBy("row", "start").agg(F.max("stop").alias("stop"))
        .withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", reached)))
        .groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"))
    )
    ids = (
        occurrences.select("row", "window").distinct().join(items, "window")
        .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return documents.join(covered, "row", "left").join(ids, "row", "left").select(
        "row", "doc_id", "text_key", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        listed.alias("items"), ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"),
    )
