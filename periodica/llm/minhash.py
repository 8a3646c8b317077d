"""Near duplicates by circulant MinHash with exact verification.

A document's set holds its distinct shingles of ``words`` words. Two fixed
permutations of ``UNIVERSE`` places give all signature coordinates: the first
scatters the shingles, the second is shifted by one place per coordinate, so the
coordinates of a shingle are a contiguous run of it. Bands of ``ROWS`` coordinates
propose candidates; with ``BANDS`` bands a pair at similarity 0.8 is missed with
probability (1 - 0.8**5)**32, 3 in a million.

Documents of equal sets form a class and only its representative goes on. Candidates
are linked to the first member of their band bucket, never with each other, and the
connected groups of those links are the search spaces. Inside them links are found on
full sets: a group of bounded size is one task; a larger one is dealt into blocks
and every pair of blocks is a task, so no link between any two texts is lost and
no task holds more than two blocks. A task returns a spanning forest of its links,
not all of them.

Null texts and texts without words have the empty set, which is linked with nothing.
Rows that repeat an id and a text are in one class, rows that repeat an id with
different texts are documents of their own; a null id never becomes a component id
while any member has one. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import space_words, staged, text_key

UNIVERSE, BANDS, ROWS = 1 << 20, 32, 5
#: Shingles that one block of a large group holds about.
BLOCK_SHINGLES = 500_000
_COORDINATES = BANDS * ROWS
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)

_TABLES: dict = {}


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and all runs of the second, which goes on after its end with its begin."""
    if not _TABLES:
        draw = np.random.default_rng(20240229)
        first = draw.permutation(UNIVERSE).astype(np.int32)
        second = draw.permutation(UNIVERSE).astype(np.int32)
        circle = np.concatenate((second, second[:_COORDINATES]))
        _TABLES["both"] = first, np.lib.stride_tricks.sliding_window_view(circle, _COORDINATES)
    return _TABLES["both"]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _FACTOR
    return values ^ (values >> np.uint64(29))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a text; with fewer words, of all of them as one."""
    found = space_words(text)
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mixed(out * _OTHER + hashes[i : n + i])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value over the set in each coordinate, in slices of bounded memory."""
    first, runs = permutations()
    places = first[(shingles % np.uint64(UNIVERSE)).astype(np.int64)]
    best = np.full(_COORDINATES, UNIVERSE, np.int32)
    for low in range(0, len(places), 2048):
        np.minimum(best, runs[places[low : low + 2048]].min(axis=0), out=best)
    return best


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for i in range(ROWS):
        out = _mixed(out * _OTHER + rows[:, i])
    return out.view(np.int64)


def features(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (of the whole set, null if empty), ``bands`` and ``text_key``."""
    kind = docs.schema[doc_id].dataType

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                sizes, keys, bands, texts = [], [], [], part.column(1).to_pylist()
                for value in texts:
                    shingles = shingle_set(value, words)
                    sizes.append(len(shingles))
                    keys.append(xxhash.xxh3_128_digest(shingles) if len(shingles) else None)
                    bands.append(band_hashes(signature(shingles)) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(map(text_key, texts), pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "bands", "text_key"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(
        describe, f"doc_id {kind.simpleString()}, n_shingles long, set_key binary, bands array<long>, text_key binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of an undirected graph of long ids: alternating large and small stars.

    Each round links every node's larger, then its smaller neighbours to the smallest
    one, until nothing changes; rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder. A node with many links meets its
    minimum in a partial aggregate and a join of many rows with one.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """(u, v) of every neighbour v of u, as (v, smallest neighbour of u or u)."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        return pairs.join(least, F.col("u") == F.col("w"))

    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), name)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = staged(large, name)
        small = star(large)
        now = staged(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u > v").distinct(),
            name,
        )
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def candidate_links(classes: DataFrame) -> DataFrame:
    """(a, b): every class with the first class of each of its band buckets."""
    rows = staged(classes.select("node", F.explode("bands").alias("band")), "bands")
    hubs = rows.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    return rows.join(hubs.select("band", "hub"), "band").where("node > hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b"))


def forest(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest of the graph of all pairs with enough similarity.

    One document after the other is compared with all that are not reached yet, at
    once, on full sets: what it reaches is reached, and compared in turn.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    rows = [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    mark = np.zeros(len(values), np.int32)
    open_ = np.argsort(sizes, kind="stable")
    queue: list[int] = []
    while len(open_):
        if queue:
            here = queue.pop()
        else:
            here, open_ = int(open_[0]), open_[1:]
        # Sets that differ too much in size cannot be similar enough.
        fits = open_[(100 * sizes[open_] >= percent * sizes[here]) & (percent * sizes[open_] <= 100 * sizes[here])]
        if not len(fits):
            continue
        mark[rows[here]] = 1
        starts = np.cumsum(sizes[fits]) - sizes[fits]
        shared = np.add.reduceat(mark[np.concatenate([rows[i] for i in fits])], starts)
        mark[rows[here]] = 0
        linked = fits[100 * shared >= percent * (sizes[here] + sizes[fits] - shared)]
        if len(linked):
            yield from ((here, int(i)) for i in linked)
            queue.extend(linked.tolist())
            open_ = open_[~np.isin(open_, linked)]


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, words: int, percent: int, doc_id: str,
                   text: str) -> DataFrame:
    """(a, b): spanning links of the exact similarity graph within every candidate group."""
    members = groups.join(classes.select("node", "first_id", "set_key", "n_shingles"), "node")
    load = members.groupBy("root").agg(F.sum("n_shingles").alias("load"))
    blocks = F.ceil(F.col("load") / BLOCK_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own"))
    tasks = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(others, lambda b: F.struct(F.least("own", b).alias("i"), F.greatest("own", b).alias("j"))))
    placed = (
        members.join(load.select("root", blocks.alias("blocks")), "root").withColumn("own", own)
        .select("root", "node", "first_id", "set_key", tasks.alias("tasks"))
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = (
        placed.join(texts, F.col("first_id").eqNullSafe(F.col("doc_id")))
        .select("root", "node", "set_key", "text", F.explode("tasks").alias("task"))
        .select("root", "task.i", "task.j", "node", "set_key", "text")
    )

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, np.ndarray] = {}
        for node, key, value in zip(pdf["node"], pdf["set_key"], pdf["text"], strict=True):
            # An id can come with another text as well; the set tells which one is meant.
            if node not in sets and xxhash.xxh3_128_digest(found := shingle_set(value, words)) == bytes(key):
                sets[node] = found
        nodes = list(sets)
        links = list(forest(list(sets.values()), percent)) if len(nodes) > 1 else []
        return pd.DataFrame({"a": [nodes[i] for i, _ in links], "b": [nodes[j] for _, j in links]}, dtype="int64")

    return dealt.groupBy("root", "i", "j").applyInPandas(link, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 * intersection >= percent * union of their sets;
    ``component_id`` is the smallest id that links reach.
    """
    rows = staged(features(docs, words, doc_id, text), "features")
    classes = staged(
        rows.where(F.col("set_key").isNotNull()).groupBy("set_key")
        .agg(F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n_shingles"),
             F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    groups = components(candidate_links(classes), "candidate-groups")
    roots = groups.select(F.col("root").alias("node"), "root").distinct()
    groups = staged(groups.unionByName(roots), "groups")
    links = staged(verified_links(docs, classes, groups, words, percent, doc_id, text), "links")
    joined = components(links, "components")
    label = (
        classes.select("node", "set_key", "first_id").join(joined, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = label.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = label.join(smallest, "root").select(F.col("set_key").alias("key"), "component_id")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.drop("bands").join(by_set, F.col("set_key") == F.col("key"), "left").select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
