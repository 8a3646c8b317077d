"""Interpolated modified Kneser-Ney language model of order three.

Counting runs in Spark: tasks fold the tokens they read to sorted arrays of distinct
keys, the arrays are shuffled in pieces by a hash of the key, and each bucket merges
its pieces. What a bucket keeps is written once, to the shared folder, as sorted
arrays, which scoring workers map into memory:

* ``words``, ``counts``, ``stats``: the sorted word hashes (the place of a word is its
  id), their counts, and what is known of each word as a context and as a continuation.
* ``contexts``: the sorted keys (word id, word id) of all pairs, for each the sorted ids
  of the words that follow it with their counts, and the sums of those with many.
* ``pairs``: in the order of those keys, how many words each pair follows.

A count takes one byte, and those that do not fit are listed beside with 64 bits, so no
count wraps. No array passes through the driver; it sees sums per bucket only. A worker
opens the arrays that its texts need and holds a bounded number and size of them.

Buckets are dealt by hashes of the two words before, so a word that makes up a third of
all tokens is spread with its contexts, and a pair that does is one entry per task and
following word. Pairs at the begin of a text have no word before; as is usual their own
counts take the place of the number of words they follow. Every token of every training
text counts.

A null text is empty, and an empty text is its end token alone. Rows that repeat an
id count each time. Without training rows every probability is one. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import crc_remainder_column, new_folder, space_words, text_of

#: Hash of the end token, which holds white space and so is no word.
END = xxhash.xxh3_64_intdigest(b" ")
#: Training tokens per bucket, and distinct keys a task holds before it gives them out.
BUCKET_TOKENS, HELD = 3_000_000, 3_000_000
#: Documents scored together.
SCORED = 500
#: Files of a model that a worker holds open, or has read where they cannot be mapped, and their bytes.
OPEN, READ, MAPPED = 256, 16, 256 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PIECE = "bucket long, keys binary, values binary"
_TRIPLES = "bucket long, keys binary, runs binary, words binary, values binary"
#: Numbers of a word: followers seen once, twice, more often, their sum; words it follows.
_STATS = 5


# -- arrays in the shared folder -----------------------------------------------------


def _write(path: str, *arrays: np.ndarray) -> None:
    """The arrays' bytes, under a name of its own first, so that a retried task does no harm."""
    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    part = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        for array in arrays:
            if array.size:
                out.write(memoryview(np.ascontiguousarray(array)).cast("B"))
    system.move(part, place)


class _Arrays:
    """The arrays of a model, opened when they are asked for; at most ``OPEN`` of ``MAPPED`` bytes are held.

    A mapped array keeps a file handle and a map, of which a process has a limited
    number, while a large model has an array of each kind for every few megabytes of
    text; and its pages count as memory of the worker. In a store that cannot be mapped
    an array is read whole; it has a bucket's part of the entries, and ``READ`` are held.
    """

    def __init__(self, folder: str):
        self.system, self.place = fs.FileSystem.from_uri(folder)
        self.local = isinstance(self.system, fs.LocalFileSystem)
        self.held: OrderedDict[str, np.ndarray] = OrderedDict()
        self.bytes = 0

    def get(self, name: str, bucket: int, kind: str) -> np.ndarray:
        path = f"{self.place}/{name}/{bucket}"
        if path in self.held:
            self.held.move_to_end(path)
            return self.held[path]
        while self.held and (len(self.held) >= (OPEN if self.local else READ) or self.bytes > MAPPED):
            self.bytes -= self.held.popitem(last=False)[1].nbytes
        if self.system.get_file_info(path).size == 0:
            found = np.zeros(0, kind)
        elif self.local:
            found = np.memmap(path, kind, "r")
        else:
            with self.system.open_input_stream(path) as source:
                found = np.frombuffer(source.read(), kind)
        self.held[path] = found
        self.bytes += found.nbytes
        return found


def _write_parts(path: str, parts: list[np.ndarray]) -> None:
    """Several arrays in one file: their number, their sizes, and each from a multiple of 8 bytes on."""
    head = np.asarray([len(parts), *(a.nbytes for a in parts)], "<u8")
    filled = ((a, np.zeros(-a.nbytes % 8, np.uint8)) for a in parts)
    _write(path, head, *itertools.chain.from_iterable(filled))


def _parts(raw: np.ndarray, kinds: list[str]) -> list[np.ndarray]:
    """Views of the arrays in a file; empty ones of an empty file."""
    if not len(raw):
        return [np.zeros(0, kind) for kind in kinds]
    raw = np.asarray(raw)
    sizes = raw[8 : 8 + 8 * len(kinds)].view("<u8").astype(np.int64)
    ends = 8 + 8 * len(kinds) + np.cumsum(sizes + -sizes % 8)
    starts = ends - (sizes + -sizes % 8)
    return [raw[a : a + n].view(kind) for a, n, kind in zip(starts, sizes, kinds, strict=True)]


#: Contexts between two stored starts of their followers, and followers from which a context's sums are listed.
_BLOCK, _LISTED = 64, 16
_SMALL = ["u1", "<u4", "<u8"]
_CONTEXTS = ["<u8", "<u4", *_SMALL, "<u8", "<u2", "<u4", "<u8", "<u4", "<u8"]
_WORDS = [*_SMALL * _STATS]


def _small(values: np.ndarray, kind: str = "u1") -> list[np.ndarray]:
    """Numbers in a small type; places and values of those that do not fit."""
    most = np.iinfo(kind).max
    large = np.flatnonzero(values >= most)
    return [np.minimum(values, most).astype(kind), _narrow(large, "<u4"), values[large].astype("<u8")]


def _small_at(parts: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    small, places, values = parts
    out = small[at].astype(np.int64)
    large = np.flatnonzero(out == np.iinfo(small.dtype).max)
    out[large] = values[np.searchsorted(places, at[large])]
    return out


class _Contexts:
    """The contexts of a bucket: sorted keys, and behind each the sorted words that follow it, with counts."""

    def __init__(self, raw: np.ndarray):
        parts = _parts(raw, _CONTEXTS)
        self.keys, self.words, self.counts = parts[0], parts[1], parts[2:5]
        self.blocks, self.offsets, self.listed, self.sums = parts[5], parts[6:9], parts[9], parts[10].reshape(-1, 3)

    @staticmethod
    def parts(pair: np.ndarray, word: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        """What is stored of distinct (pair, word) in order."""
        first = _starts(pair)
        starts = np.append(first, len(pair))
        blocks = starts[::_BLOCK]
        listed = np.flatnonzero(np.diff(starts) >= _LISTED)
        sums = [np.add.reduceat(x.astype(np.int64), first)[listed] if len(first) else first
                for x in (count, count == 1, count == 2)]
        return [
            pair[first].astype("<u8"), word.astype("<u4"), *_small(count), blocks.astype("<u8"),
            *_small(starts - np.repeat(blocks, _BLOCK)[: len(starts)], "<u2"), _narrow(listed, "<u4"),
            np.stack(sums, axis=1).astype("<u8"),
        ]

    def start(self, at: np.ndarray) -> np.ndarray:
        return self.blocks[at // _BLOCK].astype(np.int64) + _small_at(self.offsets, at)

    def stats(self, at: np.ndarray, low: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(N1, N2, N3+, sum) of contexts: listed where many words follow, else from their counts."""
        size, out = end - low, np.zeros((len(at), 4), np.int64)
        few = np.flatnonzero(size < _LISTED)
        if len(few):
            first = np.cumsum(size[few]) - size[few]
            counts = _small_at(self.counts, np.repeat(low[few] - first, size[few]) + np.arange(size[few].sum()))
            for column, x in ((3, counts), (0, counts == 1), (1, counts == 2)):
                out[few, column] = np.add.reduceat(x.astype(np.int64), first)
        many = np.flatnonzero(size >= _LISTED)
        out[many[:, None], [3, 0, 1]] = self.sums[np.searchsorted(self.listed, at[many])]
        out[:, 2] = size - out[:, 0] - out[:, 1]
        return out

    def count(self, low: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The count of each wanted word between ``low`` and ``end``, by halving."""
        high, out = end, np.zeros(len(low), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            less = self.words[np.minimum(middle, len(self.words) - 1)] < wanted
            low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
        there = low < end
        there[there] = self.words[low[there]] == wanted[there]
        out[there] = _small_at(self.counts, low[there])
        return out


def _narrow(array: np.ndarray, kind: str) -> np.ndarray:
    """The array in a smaller type, refused where a number does not fit."""
    if len(array) and array.max() > np.iinfo(kind).max:
        raise OverflowError(f"{array.max()} does not fit {np.dtype(kind).name}")
    return array.astype(kind)


def _absent(path: str, buckets: int) -> list[int]:
    """Buckets that no key fell into, so that no task wrote them."""
    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(place, recursive=True)
    found = {info.base_name for info in system.get_file_info(fs.FileSelector(place))}
    return [b for b in range(buckets) if str(b) not in found]


def _pack(array: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed: small numbers take little room."""
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=keys.dtype.type(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _fold(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values, row by row."""
    key, value = np.concatenate(keys), np.concatenate(values)
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(value[order], first, axis=0)


def _spread(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, by a hash of it."""
    mixed = keys * _MIX
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX) >> np.uint64(33)) % np.uint64(buckets)


def _ranges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, by its leading bits: buckets in turn are sorted as a whole."""
    return (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _pieces(keys: np.ndarray, values: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket with its keys, still sorted, and their values."""
    order = np.argsort(bucket, kind="stable")
    keys, values, bucket = keys[order], values[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else []
    for a, b in itertools.pairwise([*cuts, len(keys)]):
        yield _piece(bucket[a], keys=_pack_keys(keys[a:b]), values=_pack(values[a:b].astype("<u8").ravel()))


def _piece(bucket: int, **columns: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"bucket": pa.array([int(bucket)], pa.int64()), **{k: pa.array([v], pa.binary()) for k, v in columns.items()}})


def _frame(pieces: list[pa.RecordBatch]) -> pd.DataFrame:
    return pd.concat([p.to_pandas() for p in pieces], ignore_index=True)


def _merge(pdf: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    keys = [_unpack_keys(k) for k in pdf["keys"]]
    values = [_unpack(v, np.uint64).reshape(-1, width).astype(np.int64) for v in pdf["values"]]
    return _fold(keys, values)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)


def _fold_triples(pairs: list[np.ndarray], words: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct (pair, word) in order, and the sums of their counts."""
    pair, word, count = np.concatenate(pairs), np.concatenate(words), np.concatenate(counts)
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    rank = np.zeros(len(pair), np.uint64)
    rank[_starts(pair)[1:]] = 1
    # The place of the pair and the word together fit 64 bits, and runs of a pair stay in place.
    key = np.cumsum(rank, dtype=np.uint64) << np.uint64(32) | word[order].astype(np.uint64)
    inner = np.argsort(key, kind="stable")
    key = key[inner]
    first = _starts(key)
    return pair[first], key[first].astype(np.uint32), np.add.reduceat(count[order][inner], first) if len(first) else count


def _triple_pieces(pair: np.ndarray, word: np.ndarray, count: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its pairs, how many words follow each, these words, and the counts."""
    order = np.argsort(bucket, kind="stable")
    pair, word, count, bucket = pair[order], word[order], count[order], bucket[order]
    for a, b in itertools.pairwise([*_starts(bucket), len(bucket)]):
        first = _starts(pair[a:b])
        yield _piece(
            bucket[a], keys=_pack_keys(pair[a:b][first]), runs=_pack(np.diff(first, append=b - a).astype("<u4")),
            words=_pack(word[a:b]), values=_pack(count[a:b].astype("<u8")))


def _merge_triples(pdf: pd.DataFrame):
    pairs = [np.repeat(_unpack_keys(k), _unpack(r, np.uint32)) for k, r in zip(pdf["keys"], pdf["runs"], strict=True)]
    return _fold_triples(
        pairs, [_unpack(w, np.uint32) for w in pdf["words"]], [_unpack(v, np.uint64).astype(np.int64) for v in pdf["values"]])


# -- tokens --------------------------------------------------------------------------


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts in turn, and where each text begins."""
    words = [space_words(t) for t in texts]
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    digest = xxhash.xxh3_64_intdigest
    flat = itertools.chain.from_iterable((*map(digest, w), END) for w in words)
    return np.fromiter(flat, np.uint64, int(sizes.sum())), np.cumsum(sizes) - sizes


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for low in range(0, batch.num_rows, SCORED):
            part = batch.slice(low, SCORED)
            yield part, part.column(column).to_pylist()


def _history(ids: np.ndarray, starts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before the one before, and the one before, of each token; ``begin`` where a text has none."""
    one = np.concatenate((ids[:1], ids[:-1]))
    one[starts] = begin
    two = np.concatenate((one[:1], one[:-1]))
    two[starts] = begin
    return two, one


class _Held:
    """Distinct keys with counts, folded now and then and given out when they are many."""

    def __init__(self, bucket):
        self.bucket, self.keys, self.counts, self.size, self.folded = bucket, [], [], 0, 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)
        if self.size > max(HELD // 4, 2 * self.folded):
            self.fold()
        if self.folded > HELD:
            yield from self.flush()

    def fold(self) -> None:
        keys, counts = _fold(self.keys, self.counts)
        self.keys, self.counts, self.size, self.folded = [keys], [counts], len(keys), len(keys)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.keys:
            self.fold()
            keys, counts = self.keys[0], self.counts[0]
            yield from _pieces(keys, counts, self.bucket(keys))
        self.keys, self.counts, self.size, self.folded = [], [], 0, 0


class _HeldTriples:
    """The same for triples."""

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size, self.folded = buckets, [], 0, 0

    def add(self, pairs: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(_fold_triples([pairs], [words], [np.ones(len(pairs), np.int64)]))
        self.size += len(self.held[-1][0])
        if self.size > max(HELD // 4, 2 * self.folded):
            self.fold()
        if self.folded > HELD:
            yield from self.flush()

    def fold(self) -> None:
        self.held = [_fold_triples(*zip(*self.held, strict=True))]
        self.size = self.folded = len(self.held[0][0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self.fold()
            yield from _triple_pieces(*self.held[0], _spread(self.held[0][0], self.buckets))
        self.held, self.size, self.folded = [], 0, 0


# -- the stored model ----------------------------------------------------------------


def _discounts(counts: list[int]) -> list[float]:
    """The three discounts from the numbers of keys that occur once to four times."""
    n1, n2, n3, n4 = counts
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        y = n1 / (n1 + 2 * n2) if n1 else 0.0
        d = k - (k + 1) * y * b / a if a else 0.0
        out.append(min(max(d, 0.0), float(k)) if a and n1 else 0.5)
    return out


def _count_counts(values: np.ndarray) -> list[int]:
    return [int((values == k).sum()) for k in (1, 2, 3, 4)] + [int((values >= 3).sum())]


@dataclass
class Model:
    """Where the arrays lie, and the sums that the driver knows."""

    folder: str
    word_buckets: int
    pair_buckets: int
    bases: list[int]
    train_tokens: int
    train_docs: int
    triple_discounts: list[float]
    pair_discounts: list[float]
    word_discounts: list[float]
    pair_types: int
    begin: tuple[int, int, int, int]
    unseen_mass: float

    @property
    def vocabulary(self) -> int:
        return self.bases[-1]


class _Words:
    """Ids of words, by the mapped hash arrays."""

    def __init__(self, arrays: _Arrays, buckets: int, bases: list[int]):
        self.arrays, self.bases, self.buckets = arrays, bases, buckets

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each hash, -1 where it is unknown."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        bucket = _ranges(distinct, self.buckets)
        for b, low, high in _runs(bucket):
            known = self.arrays.get("words", b, "<u8")
            if len(known):
                at = np.minimum(np.searchsorted(known, distinct[low:high]), len(known) - 1)
                out[low:high] = np.where(known[at] == distinct[low:high], at + self.bases[b], -1)
        return out[back]


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cuts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else []
    for a, b in itertools.pairwise([*cuts, len(sorted_values)]):
        yield int(sorted_values[a]), int(a), int(b)


class _Scorer:
    """The mapped arrays of a model."""

    def __init__(self, model: Model):
        self.m = model
        self.arrays = _Arrays(model.folder)
        self.words = _Words(self.arrays, model.word_buckets, model.bases)

    def of_words(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and the numbers of ``_STATS``, of known ids."""
        distinct, back = np.unique(ids, return_inverse=True)
        counts, stats = np.zeros(len(distinct), np.int64), np.zeros((len(distinct), _STATS), np.int64)
        bucket = np.searchsorted(np.asarray(self.m.bases), distinct, side="right") - 1
        for b, low, high in _runs(bucket):
            at = distinct[low:high] - self.m.bases[b]
            counts[low:high] = _small_at(_parts(self.arrays.get("counts", b, "u1"), _SMALL), at)
            parts = _parts(self.arrays.get("stats", b, "u1"), _WORDS)
            for i in range(_STATS):
                stats[low:high, i] = _small_at(parts[3 * i : 3 * i + 3], at)
        return counts[back], stats[back]

    def _found(self, keys: np.ndarray) -> Iterator[tuple[int, _Contexts, np.ndarray, np.ndarray]]:
        """By bucket: its contexts, which of the asked keys are there, and their places."""
        bucket = _spread(keys, self.m.pair_buckets)
        order = np.argsort(bucket, kind="stable")
        for b, low, high in _runs(bucket[order]):
            contexts, mine = _Contexts(self.arrays.get("contexts", b, "u1")), order[low:high]
            if len(contexts.keys):
                at = np.minimum(np.searchsorted(contexts.keys, keys[mine]), len(contexts.keys) - 1)
                there = contexts.keys[at] == keys[mine]
                yield b, contexts, mine[there], at[there]

    def of_pairs(self, keys: np.ndarray) -> np.ndarray:
        """How many words each pair follows; at the begin of a text, how often it occurs."""
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        for b, _, mine, at in self._found(distinct):
            out[mine] = _small_at(_parts(self.arrays.get("pairs", b, "u1"), _SMALL), at)
        return out[back]

    def of_triples(self, keys: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each word after its pair; the pair's (N1, N2, N3+, sum)."""
        counts, stats = np.zeros(len(keys), np.int64), np.zeros((len(keys), 4), np.int64)
        for _, contexts, mine, at in self._found(keys):
            low, end = contexts.start(at), contexts.start(at + 1)
            stats[mine] = contexts.stats(at, low, end)
            counts[mine] = contexts.count(low, end, words[mine])
        return counts, stats

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Token and known-token numbers, base score and score of each text."""
        m, (hashes, starts) = self.m, _tokens(texts)
        ids, size = self.words.ids(hashes), np.uint64(m.vocabulary + 1)
        known = ids >= 0
        counts, stats = np.zeros(len(ids), np.int64), np.zeros((len(ids), _STATS), np.int64)
        if known.any():
            counts[known], stats[known] = self.of_words(ids[known])
        base = np.log10((counts + 0.1) / (m.train_tokens + 0.1 * (m.vocabulary + 1)))

        low = np.asarray([0.0, *m.word_discounts])[np.minimum(stats[:, 4], 3)]
        floor = m.unseen_mass / (m.vocabulary + 1)
        probability = np.maximum(stats[:, 4] - low, 0.0) / max(m.pair_types, 1) + floor

        two, one = _history(ids, starts, m.vocabulary)
        context = np.concatenate((np.zeros((1, 4), np.int64), stats[:-1, :4]))
        context[starts] = m.begin
        pair = np.zeros(len(ids), np.int64)
        both = (one >= 0) & known
        if both.any():
            pair[both] = self.of_pairs(one[both].astype(np.uint64) * size + ids[both].astype(np.uint64))
        probability = _interpolated(pair, context, m.pair_discounts, probability)

        triple, context = np.zeros(len(ids), np.int64), np.zeros((len(ids), 4), np.int64)
        both = (one >= 0) & (two >= 0)
        if both.any():
            triple[both], context[both] = self.of_triples(two[both].astype(np.uint64) * size + one[both].astype(np.uint64), ids[both])
        logs = np.log10(_interpolated(triple, context, m.triple_discounts, probability))
        sums = [np.add.reduceat(x, starts) for x in (np.ones(len(ids), np.int64), known.astype(np.int64), base, logs)]
        return tuple(sums)


def _interpolated(counts: np.ndarray, context: np.ndarray, discounts: list[float], lower: np.ndarray) -> np.ndarray:
    """The probability in contexts (N1, N2, N3+, sum); the lower order's where a context is unseen."""
    discount, total = np.asarray([0.0, *discounts]), np.maximum(context[:, 3], 1)
    own = np.maximum(counts - discount[np.minimum(counts, 3)], 0.0) / total
    return np.where(context[:, 3] > 0, own + context[:, :3] @ discount[1:] / total * lower, lower)


_SCORERS: dict = {}


def _scorer(model: Model) -> _Scorer:
    if model.folder not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.folder] = _Scorer(model)
    return _SCORERS[model.folder]


# -- training and scoring ------------------------------------------------------------


def _count_words(batches, buckets: int):
    held = _Held(partial(_ranges, buckets=buckets))
    for _, texts in _slices(batches, 0):
        yield from held.add(_tokens(texts)[0])
    yield from held.flush()


def _merge_words(pdf: pd.DataFrame, folder: str) -> pd.DataFrame:
    bucket = int(pdf["bucket"].iloc[0])
    keys, counts = _merge(pdf, 1)
    _write(f"{folder}/words/{bucket}", keys.astype("<u8"))
    _write_parts(f"{folder}/counts/{bucket}", _small(counts.ravel()))
    return pd.DataFrame({"bucket": [bucket], "types": [len(keys)], "tokens": [int(counts.sum())]})


def _count_triples(batches, folder: str, word_buckets: int, bases: list[int], buckets: int):
    words, begin = _Words(_Arrays(folder), word_buckets, bases), bases[-1]
    held, size = _HeldTriples(buckets), np.uint64(begin + 1)
    for _, texts in _slices(batches, 0):
        hashes, starts = _tokens(texts)
        if not len(hashes):
            continue
        ids = words.ids(hashes).astype(np.uint64)
        two, one = _history(ids, starts, begin)
        # The last pair of a text is followed by its begin, so that every pair is a context.
        last = np.append(starts[1:], len(ids)) - 1
        yield from held.add(
            np.concatenate((two * size + one, one[last] * size + ids[last])),
            np.concatenate((ids, np.full(len(last), begin, np.uint64))).astype(np.uint32))
    yield from held.flush()


def _bucket_of_id(ids: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """The word bucket of each id; the id of the begin stands in a bucket after the last."""
    return np.searchsorted(bases, ids.astype(np.int64), side="right") - 1


def _merge_triples_of(pdf: pd.DataFrame, folder: str, begin: int, buckets: int) -> pd.DataFrame:
    """Keep the contexts of a bucket; give out its last two words: how many words they follow."""
    bucket, size = int(pdf["bucket"].iloc[0]), np.uint64(begin + 1)
    pair, word, count = _merge_triples(pdf)
    _write_parts(f"{folder}/contexts/{bucket}", _Contexts.parts(pair, word, count))
    real = word != begin
    pair, word, count = pair[real], word[real].astype(np.uint64), count[real]
    middle = pair % size
    lower, follows = _fold([middle * size + word], [np.where(middle == begin, count, 1)])
    # The numbers of triples by count ride along, in a bucket before the first. The own
    # bucket is named in any case: its pairs have to be written.
    out = [_sums_piece(-2, count), *_pieces(lower, follows, _spread(lower, buckets))]
    out.append(_piece(bucket, keys=_pack_keys(lower[:0]), values=_pack(follows[:0].astype("<u8"))))
    return _frame(out)


def _sums_piece(bucket: int, counts: np.ndarray) -> pa.RecordBatch:
    return _piece(bucket, keys=_pack_keys(np.arange(5, dtype=np.uint64)), values=_pack(np.asarray(_count_counts(counts), "<u8")))


def _merge_pairs(pdf: pd.DataFrame, folder: str, bases: list[int]) -> pd.DataFrame:
    """Keep what the pairs of a bucket follow; give out what this adds to their words (``_STATS``)."""
    bucket, size = int(pdf["bucket"].iloc[0]), np.uint64(bases[-1] + 1)
    keys, counts = _merge(pdf, 1)
    counts = counts.ravel()
    if bucket < 0:
        return _frame([_piece(bucket, keys=_pack_keys(keys), values=_pack(counts.astype("<u8")))])
    known = _Contexts(_Arrays(folder).get("contexts", bucket, "u1")).keys
    follows = np.zeros(len(known), np.int64)
    follows[np.searchsorted(known, keys)] = counts
    _write_parts(f"{folder}/pairs/{bucket}", _small(follows))
    zero = np.zeros(len(counts), np.int64)
    first = np.stack([counts == 1, counts == 2, counts >= 3, counts, zero], axis=1).astype(np.int64)
    second = np.stack([zero, zero, zero, zero, zero + 1], axis=1)
    ids, stats = _fold([keys // size, keys % size], [first, second])
    return _frame([_sums_piece(-1, counts), *_pieces(ids, stats, _bucket_of_id(ids, np.asarray(bases)))])


def _merge_stats(pdf: pd.DataFrame, folder: str, bases: list[int]) -> pd.DataFrame:
    """Write the statistics of a word bucket in the order of its ids; return the sums of it."""
    bucket = int(pdf["bucket"].iloc[0])
    if bucket < 0:
        keys, sums = _merge(pdf, 1)
        return pd.DataFrame({"bucket": [bucket], "sums": [sums.ravel().tolist()]})
    ids, stats = _merge(pdf, _STATS)
    if bucket == len(bases) - 1:
        return pd.DataFrame({"bucket": [bucket], "sums": [stats[0].tolist()]})
    dense = np.zeros((bases[bucket + 1] - bases[bucket], _STATS), np.int64)
    dense[ids.astype(np.int64) - bases[bucket]] = stats
    _write_parts(f"{folder}/stats/{bucket}", [part for column in dense.T for part in _small(column)])
    return pd.DataFrame({"bucket": [bucket], "sums": [[*_count_counts(dense[:, 4]), int(dense[:, 4].sum())]]})


def train(docs: DataFrame, text: str = "text") -> Model:
    """A model of all texts of ``docs``.

    The texts are read twice, for words and for triples. The driver receives one row of
    sums per bucket.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "language-model")
    # A folder without a scheme lies in the default file system, which workers have to name.
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    folder = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    folder = folder.replace("file:/", "file:///", 1) if not folder.startswith("file://") else folder
    texts = docs.select(text_of(F.col(text)).alias("text"))
    sizes = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    # At most one token per two bytes; this only deals the work out.
    buckets = max(8, -(-int(sizes[1]) // (6 * BUCKET_TOKENS)))

    words = (
        texts.mapInArrow(partial(_count_words, buckets=buckets), _PIECE).groupBy("bucket")
        .applyInPandas(lambda pdf: _merge_words(pdf, folder), "bucket long, types long, tokens long").collect()
    )
    types = {r["bucket"]: r["types"] for r in words}
    for missing in set(range(buckets)) - set(types):
        for name in ("words", "counts", "stats"):
            _write(f"{folder}/{name}/{missing}")
    if sum(types.values()) + 1 >= 1 << 32:
        raise OverflowError("pairs of so many distinct words do not fit 64 bits")
    bases = [0, *np.cumsum([types.get(b, 0) for b in range(buckets)]).tolist()]
    tokens = sum(r["tokens"] for r in words)

    sums = (
        texts.mapInArrow(
            partial(_count_triples, folder=folder, word_buckets=buckets, bases=bases, buckets=buckets), _TRIPLES)
        .groupBy("bucket").applyInPandas(lambda pdf: _merge_triples_of(pdf, folder, bases[-1], buckets), _PIECE)
        .groupBy("bucket").applyInPandas(lambda pdf: _merge_pairs(pdf, folder, bases), _PIECE)
        .groupBy("bucket")
        .applyInPandas(lambda pdf: _merge_stats(pdf, folder, bases), "bucket long, sums array<long>").collect()
    )
    for name in ("contexts", "pairs"):
        for empty in _absent(f"{folder}/{name}", buckets):
            _write(f"{folder}/{name}/{empty}")
    by_bucket = {r["bucket"]: r["sums"] for r in sums}
    triple_counts, pair_counts = by_bucket.pop(-2, [0] * 5), by_bucket.pop(-1, [0] * 5)
    begin = by_bucket.pop(buckets, [0] * _STATS)
    for empty in range(buckets):
        if not types.get(empty):
            by_bucket.pop(empty, None)
    totals = np.sum([*by_bucket.values(), [0] * 6], axis=0).tolist()
    word_discounts = _discounts(totals[:4])
    mass = sum(d * n for d, n in zip(word_discounts, (totals[0], totals[1], totals[4]), strict=True))
    return Model(
        folder, buckets, buckets, bases, tokens, int(sizes[0]), _discounts(triple_counts[:4]), _discounts(pair_counts[:4]),
        word_discounts, totals[5], tuple(begin[:4]), mass / totals[5] if totals[5] else 1.0,
    )


def _score(batches, model: Model):
    scorer = _scorer(model)
    for part, texts in _slices(batches, 2):
        tokens, known, base, score = scorer.score(texts)
        n = part.num_rows
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(tokens), pa.array(known),
             pa.array(np.full(n, model.train_tokens)), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, model: Model, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probabilities of every text; ``held_out`` is a column that is passed on."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), text_of(F.col(text)).alias("text"))
    return rows.mapInArrow(
        partial(_score, model=model),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double",
    )


def train_and_score(docs: DataFrame, folds: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows whose crc32 of the id, modulo ``folds``, is not 0, and score all; perplexity follows
    as ``10 ** (-score / n_tokens)``."""
    held_out = crc_remainder_column(F.col(doc_id), folds) == 0
    return score(docs, train(docs.where(~held_out), text), held_out, doc_id, text)
