"""Packing of token ids into fixed-length sequences.

Texts are encoded by a public tokenizer and closed by an end id; documents longer
than a sequence are cut into full pieces and a rest. Pieces then go to randomised
groups of bounded size, and each group is packed on its own by first-fit decreasing:
pieces by falling length, each into the first sequence that still has room, found in
a tournament tree over the free capacities in logarithmic time. Texts never move;
only lengths are shuffled.

A null text is empty and gives one piece with the end id alone. Rows that repeat an
id are documents of their own. An empty table gives no pieces. Other columns are not
read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import staged, text_of

#: Chunks of text whose ids a task remembers (some 100 MB), and the longest that it does.
CACHED, CACHED_BYTES = 600_000, 64
#: Other chunks encoded in one call; what the tokenizer allocates for it is not all given back.
CALL = 2_000
#: Bytes of text whose chunks are told apart at once; a longer text is taken alone.
SLICE = 8_000_000
#: Letters that are ones in every version of Unicode, up to where the combining marks follow.
LETTERS = "".join(chr(c) for c in range(0x250) if chr(c).isalpha())

_ENCODERS: dict = {}
_BLANKS = bytes.maketrans(b"\n\t\r", b"   ")
#: What a tokenizer says of itself if ``_PIECES`` cuts a lower-case ``_PLAIN`` chunk as it does.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_PLAIN = re.compile(f"[!-~{LETTERS}]+").fullmatch
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+").findall


def byte_letters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = byte_letters()


class ChunkEncoder:
    """Ids of texts under a tokenizer that lower-cases and drops white space, remembered per chunk between it.

    No token of such a tokenizer spans white space, so the ids of a text are those of
    its chunks in turn. Chunks of plain letters and printable ASCII are cut here by the
    tokenizer's pattern, and each new piece goes straight to its vocabulary; all other
    new chunks go through the whole tokenizer with a special token between them, or
    alone if they hold that token themselves. So do all chunks if the tokenizer cuts
    in another way.
    """

    def __init__(self, path: str, mark: str = "<|startoftext|>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark, self.mark_id = mark, self.tokenizer.token_to_id(mark)
        self.model = self.tokenizer.model
        parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.cuts_here = [json.loads(p.__getstate__()) for p in parts if p] == [_NORMALIZER, _SPLIT]
        self.packed = [struct.pack("<I", i) for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.forget()

    def forget(self) -> None:
        """Drop what was remembered: a worker outlives the task, and its memory counts in whatever stage comes next."""
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        pa.default_memory_pool().release_unused()

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode_piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        packed = self.packed
        return b"".join([packed[token.id] for token in self.model.tokenize(shown)])

    def _encode_others(self, chunks: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(chunks), CALL):
            part = chunks[i : i + CALL]
            ids = self._ids(self.mark.join(part))
            cuts = 4 * np.flatnonzero(ids == self.mark_id)
            if len(cuts) != len(part) - 1:
                out.extend(self._ids(c).tobytes() for c in part)
                continue
            whole = ids.tobytes()
            out.extend(whole[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(whole)], strict=True))
        return out

    def _learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        encoded: dict[str, bytes] = {}
        new: dict[bytes, bytes] = {}
        others: list[bytes] = []
        for chunk in chunks:
            text = chunk.decode("utf-8", "surrogatepass").lower()
            if not self.cuts_here or "<|" in text or not _PLAIN(text):
                others.append(chunk)
                continue
            pieces = _PIECES(text)
            for piece in pieces:
                if piece not in encoded:
                    encoded[piece] = self._encode_piece(piece)
            new[chunk] = encoded[pieces[0]] if len(pieces) == 1 else b"".join([encoded[p] for p in pieces])
        texts = [c.decode("utf-8", "surrogatepass") for c in others]
        return new | dict(zip(others, self._encode_others(texts), strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        # Capitals can be folded before the look-up unless that could make a special token.
        raw = (t.encode("utf-8", "surrogatepass").translate(_BLANKS) for t in texts)
        split = pc.split_pattern(pa.array([b if b"<|" in b else b.lower() for b in raw], pa.large_binary()), b" ")
        chunks = split.flatten().dictionary_encode()
        used = chunks.dictionary.to_pylist()
        missing = [c for c in used if c not in self.known]
        back = {c: self.older[c] for c in missing if c in self.older}
        new = self._learn([c for c in missing if c not in back])
        if len(self.known) + len(back) + len(new) > CACHED // 2:
            # What is looked up again comes back from the older half, the rest of it goes.
            self.older, self.known = self.known, {c: self.known[c] for c in used if c in self.known}
        self.known.update(back)
        self.known.update(new)
        ids = pa.array([self.known[c] for c in used], pa.large_binary()).take(chunks.indices)
        for chunk in new:
            if len(chunk) > CACHED_BYTES:
                del self.known[chunk]
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])[split.offsets.to_numpy()]
        whole = memoryview(b"" if ids.buffers()[2] is None else ids.buffers()[2])
        for start, end in itertools.pairwise(ends.tolist()):
            yield bytes(whole[start:end])


def encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts whose texts, in column 2, have ``SLICE`` bytes at most or are single."""
    ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(), dtype=np.int64)
    low, before = 0, 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield batch.slice(low, high - low)
        low, before = high, ends[high - 1]


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``row``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``.

    ``row`` tells apart the rows of the input.
    """
    end = struct.pack("<I", end_id)
    kind = docs.schema[doc_id].dataType
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(F.col(text)).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(tokenizer)
        try:
            yield from pieces_of(batches, encoding)
        finally:
            encoding.forget()

    def pieces_of(batches: Iterator[pa.RecordBatch], encoding: ChunkEncoder) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                take, starts, lengths, crcs, totals = [], [], [], [], []
                for i, ids in enumerate(encoding.encode(part.column(2).to_pylist())):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = memoryview(ids)[4 * start : 4 * (start + length)]
                        take.append(i)
                        starts.append(start)
                        lengths.append(len(piece) // 4)
                        crcs.append(zlib.crc32(piece))
                        totals.append(total)
                index = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(index), part.column(1).take(index), *(
                        pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))],
                    names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"],
                )

    schema = f"doc_id {kind.simpleString()}, row long, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(cut, schema)


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and offset of each length, given in falling order.

    The tree holds in every node the largest free capacity below it; the first bin
    with room is found by going left wherever the left half has room.
    """
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for size in lengths:
        if size > capacity:
            raise ValueError(f"a piece of {size} does not fit in {capacity}")
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        free = tree[node]
        bins.append(node - leaves)
        offsets.append(capacity - free)
        tree[node] = free - size
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left >= right else right
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 20_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Groups are dealt by a hash of row and start, so neither a document of many pieces
    nor an id that many rows share makes a large group. More groups cost at most one
    open sequence each.
    """
    pieces = staged(pieces, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "start"], ascending=[False, True, True])
        bins, offsets = first_fit_decreasing(pdf["length"].tolist(), capacity)
        pdf["sequence_id"] = pd.Series(bins, index=pdf.index, dtype="int64") + (int(pdf["grp"].iloc[0]) << 32)
        pdf["offset"] = pd.Series(offsets, index=pdf.index, dtype="int64")
        return pdf[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return (
        pieces.withColumn("grp", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
        .groupBy("grp")
        .applyInPandas(
            fit,
            f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, **columns: str) -> DataFrame:
    """All pieces of ``docs`` with their places."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity, **columns), capacity)
