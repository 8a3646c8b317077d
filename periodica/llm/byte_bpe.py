"""Byte-level BPE by backtracking over dictionary matches.

A rank file gives the vocabulary and, by its order, the merges. A sequence of tokens
is what the merges make of its bytes exactly if every two neighbours are compatible:
merging the bytes of the two gives these two again. So a piece of text is encoded
without merging it. Its bytes, read as Latin-1, go through an automaton that finds
all tokens that start at each place; the longest compatible one is taken, and where
nothing goes on, the last one is given up for a shorter one. The tokens before a
place are the only ones possible there, so a place that led nowhere never has to be
tried again, and the work is linear in the length of the piece. Compatibility is
worked out once for a pair and remembered.

Text is split into pieces by the pattern that belongs to the ranks; a piece that is a
token by itself is that token. Frequent pieces are remembered per worker.

A null text is empty and has no ids; null ids decode to null. Repeated rows are
encoded each. An empty table gives an empty frame. Other columns are not read, so
their names do not matter. Very long texts are split in stretches and long pieces
are matched in blocks, so that a worker holds the ids of a text and little more. A
byte or an id that the vocabulary lacks is an error.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import text_of

#: Pieces a worker remembers (twice as many at most), the longest that it does, and the pairs whose compatibility it remembers.
CACHED, CACHED_CHARS, PAIRS = 250_000, 64, 500_000
#: Characters split in one go, places of a piece matched in one go, bytes of text and ids in one batch of results.
STRETCH, BLOCK, TEXTS, IDS = 1 << 18, 1 << 14, 1 << 20, 1 << 18
#: Characters that the pattern may look at beyond the end of a match, or more.
AHEAD = 8
#: Of two tokens that do not merge.
NO_RANK = 1 << 62

_ENCODERS: dict[tuple[str, str], Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


class Encoder:
    """Ids of texts under one vocabulary. The pattern must match all characters."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.sizes = [len(self.tokens.get(i, b"")) for i in range(max(self.tokens, default=0) + 1)]
        self.splitter = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_STRING)
        # A token that the merges do not make can only be a whole piece.
        for token, i in ranks.items():
            if self.merged(token) == [i]:
                self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.longest = max(self.sizes, default=1)
        self.compatible: dict[int, bool] = {}
        self.known = _Known(self)

    def merged(self, text: bytes) -> list[int]:
        """Ids of a short text by merging the lowest rank, leftmost first."""
        parts, rank = [text[i : i + 1] for i in range(len(text))], self.ranks.get
        pairs = [rank(a + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (lowest := min(pairs)) < NO_RANK:
            at = pairs.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NO_RANK)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NO_RANK)
        return [rank(part, -1) for part in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side."""
        pair = left << 32 | right
        found = self.compatible.get(pair)
        if found is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            found = self.compatible[pair] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return found

    def matches(self, piece: str, first: int, size: int) -> list[list[int]]:
        """The tokens that start at each of ``size`` places of the piece, longest first."""
        found: list[list[int]] = [[] for _ in range(size)]
        sizes = self.sizes
        for last, token in self.automaton.iter(piece, first, min(len(piece), first + size + self.longest)):
            start = last + 1 - sizes[token] - first
            if start < size:
                found[start].append(token)
        for tokens in found:
            tokens.reverse()  # they come by their end, so the longest is last
        return found

    def starting(self, piece: str) -> Callable[[int], list[int]]:
        """A function that lists the tokens that start at a place of the piece, longest first."""
        if len(piece) <= BLOCK:
            return self.matches(piece, 0, len(piece)).__getitem__
        held: dict[int, list[list[int]]] = {}

        def at(place: int) -> list[int]:
            block, offset = divmod(place, BLOCK)
            if block not in held:
                if len(held) > 1:
                    held.pop(max(held, key=lambda other: abs(other - block)))
                held[block] = self.matches(piece, block * BLOCK, min(BLOCK, len(piece) - block * BLOCK))
            return held[block][offset]

        return at

    def encode_piece(self, text: str) -> list[int]:
        data = text.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        piece, fits, sizes = data.decode("latin-1"), self.fits, self.sizes
        out = [token for _, token in self.automaton.iter_long(piece)]
        if sum(map(sizes.__getitem__, out)) == len(data) and all(map(fits, out, out[1:])):
            return out  # the longest matches, one after the other, fit at once
        starting, end = self.starting(piece), len(data)
        dead, at, out, tried = bytearray(end + 1), 0, [], [0]
        while at < end:
            options = starting(at)
            for i in range(tried[-1], len(options)):
                token = options[i]
                after = at + sizes[token]
                if not dead[after] and (not out or fits(out[-1], token)):
                    tried[-1] = i + 1
                    tried.append(0)
                    out.append(token)
                    at = after
                    break
            else:
                if not out:
                    raise ValueError(f"the vocabulary cannot spell {data[:20]!r}")
                dead[at] = 1
                tried.pop()
                at -= sizes[out.pop()]
        return out

    def pieces(self, text: str) -> Iterator[list[str]]:
        """All matches of the pattern, stretch by stretch."""
        split, at, size = self.splitter.findall, 0, STRETCH
        if self.splitter.groups:
            split = lambda part: [m.group() for m in self.splitter.finditer(part)]
        while at < len(text):
            found = split(text[at : at + size])
            if at + size >= len(text):
                yield found
                return
            # What ends near the cut may go on beyond it. Nothing before depends on that.
            cut = 0
            while found and cut < AHEAD:
                cut += len(found.pop())
            if found:
                yield found
                at, size = at + size - cut, STRETCH
            else:
                size *= 2

    def encode(self, text: str) -> np.ndarray:
        packed = b"".join([b"".join(map(self.known.__getitem__, pieces)) for pieces in self.pieces(text)])
        return np.frombuffer(packed, np.int32)


class _Known(dict):
    """Ids of pieces met lately, as 32-bit numbers in a row.

    A full dictionary is set aside and a new one begun, which takes over what is met again.
    """

    def __init__(self, encoder: Encoder):
        self.encoder, self.before = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece) or array("i", self.encoder.encode_piece(piece)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Decoder:
    """The bytes of ids, many at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.sizes = np.full(max(ranks.values(), default=0) + 1, -1)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.flat = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)
        self.starts = np.cumsum(np.maximum(self.sizes, 0)) - np.maximum(self.sizes, 0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes in a row, and how many each id has."""
        strange = (ids < 0) | (ids >= len(self.sizes))
        if strange.any() or (self.sizes[ids] < 0).any():
            raise ValueError(f"the vocabulary has no id {ids[strange | (self.sizes[np.where(strange, 0, ids)] < 0)][0]}")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.flat[places], sizes


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder whose ranks lie in ``path``, built once per worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(load_ranks(path))
    return _DECODERS[path]


def _in_groups(sizes: list[int], enough: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows, each ended by the row with which their sizes reach ``enough``."""
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= enough:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def encode(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text.

    ``ranks`` names a rank file that every executor has, ``pattern`` its splitter.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(ranks, pattern).encode
        for batch in batches:
            names, values = batch.column(0), batch.column(1)
            for first, last in _in_groups(pc.binary_length(values).to_pylist(), TEXTS):
                lists = [encode_text(t.as_py()) for t in values.slice(first, last - first)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([names.slice(first, last - first), ids], ["doc_id", "ids"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The frame of ``encode`` with the bytes of its ids as ``decoded``."""
    source = encoded.select("doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_ids = decoder(ranks).decode
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_pylist()
            for first, last in _in_groups(counts, IDS):
                part = batch.slice(first, last - first)
                ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
                flat, sizes = decode_ids(ids)
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts[first:last])])]
                texts = pa.Array.from_buffers(
                    pa.binary(), len(part), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])
                known = part.column(1).is_valid()
                texts = pc.if_else(known, texts, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], ["doc_id", "ids", "decoded"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
