"""Hard negatives by length buckets and coordinate pruning.

Rows are sorted by the length of their vectors and cut into buckets. A bucket holds
its rows once and, for every coordinate, the list of them in the order of that
coordinate of their directions. An anchor that looks for rows with at least some
score needs, in a bucket whose longest row is known, at least some cosine; that
bounds every coordinate of the rows' directions around the anchor's own. For its
focus coordinates, the largest by amount, the feasible ranges are looked up in the
sorted lists; the shortest list gives the candidates, the other ranges thin them out,
and the rest are verified by exact integer products. The score asked for rises as rows
are found, so later buckets are cut more or skipped.

Anchors, a stated share of all rows, are compared with all rows in blocks: a task has
blocks of anchors and buckets and keeps, for each anchor, the few best rows it has met.
Those of all tasks are then ranked together. First every anchor finds its positives;
each of them then bounds the scores of its negatives from both sides.

Rows with a null label, a null vector or a null or non-finite component take no part.
Every component x becomes floor(scale * x); it must fit 31 bits and scores must fit 61,
else there is an error. Shorter vectors count as filled up with zeros. A null id is
neither an anchor nor relabelled and comes last in ties; rows that repeat an id are
rows of their own and equal in rank. Without positives an anchor has no result, and
a positive with a negative score has no negatives. An empty table gives an empty
frame. Other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodica.llm.common import staged

#: Rows of a bucket, anchors of a block, and focus coordinates of an anchor.
BUCKET, BLOCK, FOCUS = 2048, 256, 4
#: An anchor whose shortest list has less than this share of a bucket is verified row by row, any other by one product.
FEW = 8
#: Room for rounding in feasible ranges of coordinates between -1 and 1.
ROOM = 1e-5
#: Stands for a null id; ids come in ascending order.
NO_ID = np.iinfo(np.int64).max
#: No score reaches these.
LEAST, MOST = -(1 << 62), 1 << 62

_BUCKETS = "bucket long, size int, longest double, ids binary, labels binary, rows binary, lists binary"
_ANCHORS = "anchor long, vec_id long, label long, length double, row array<int>"
_FOUND = "anchor long, slot int, uid long, vec_id long, score long"


def integer_rows(
    vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, label, length, row) of the rows that take part."""
    source = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(embedding).alias("embedding"),
    ).where("label IS NOT NULL AND embedding IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            flat = np.floor(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            fine = np.ones(len(sizes), bool)
            fine[owner[~np.isfinite(flat)]] = False
            flat = flat[fine[owner]]
            if (np.abs(flat) >= 1 << 31).any():
                raise ValueError(f"a component times {scale} does not fit 31 bits")
            length = np.sqrt(np.bincount(owner[fine[owner]], np.square(flat), len(sizes)))[fine]
            if (length >= 2.0**30).any():
                raise ValueError("scores of the longest rows do not fit 61 bits")
            kept = batch.filter(pa.array(fine))
            offsets = np.concatenate([[0], np.cumsum(sizes[fine])]).astype(np.int32)
            rows = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(length), rows], ["vec_id", "label", "length", "row"])

    return source.mapInArrow(run, "vec_id long, label long, length double, row array<int>")


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` get the next label."""
    moved = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    return rows.withColumn("label", F.when(moved, (F.col("label") + 1) % labels).otherwise(F.col("label")))


def _filled(column: pa.ListArray) -> np.ndarray:
    """Lists as a matrix, shorter ones filled up with zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _directions(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows.astype(float), axis=1)
    return (rows / np.where(lengths > 0, lengths, 1)[:, None]).astype(np.float32)


def bucket_record(number: int, table: pa.Table) -> pa.RecordBatch:
    """A bucket of rows, given by falling length, as one record."""
    matrix = _filled(table.column("row").combine_chunks())
    lists = np.argsort(_directions(matrix), axis=0, kind="stable").astype(np.uint16)
    columns = {
        "bucket": pa.array([number], pa.int64()), "size": pa.array([len(matrix)], pa.int32()),
        "longest": table.column("length")[:1].combine_chunks(),
    }
    ids, labels = pc.fill_null(table.column("vec_id"), NO_ID).to_numpy(), table.column("label").to_numpy()
    for name, values in (("ids", ids), ("labels", labels), ("rows", matrix), ("lists", lists.T)):
        columns[name] = pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def length_buckets(rows: DataFrame) -> DataFrame:
    """The rows by falling length, cut into buckets with a sorted list for each coordinate.

    A range of lengths that many rows share is split by id.
    """
    ordered = rows.repartitionByRange(F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id", "row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= BUCKET:
                table = pa.Table.from_batches(held)
                yield bucket_record(number, table.slice(0, BUCKET))
                number, held, n = number + 1, table.slice(BUCKET).to_batches(), n - BUCKET
        if n:
            yield bucket_record(number, pa.Table.from_batches(held))

    return ordered.mapInArrow(cut, _BUCKETS)


class Bucket:
    """A stored bucket as arrays. The place of a row in all buckets is its ``uid``."""

    def __init__(self, record: dict):
        n = record["size"]
        self.longest = record["longest"]
        self.ids = np.frombuffer(record["ids"], np.int64)
        self.labels = np.frombuffer(record["labels"], np.int64)
        self.rows = np.frombuffer(record["rows"], np.int32).reshape(n, -1)
        self.lists = np.frombuffer(record["lists"], np.uint16).reshape(-1, n)
        self.uids = record["bucket"] * BUCKET + np.arange(n)
        self.directions = _directions(self.rows)


def anchor_rows(buckets: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, with their ``uid`` as ``anchor``."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                b = Bucket(record)
                found = np.flatnonzero((b.ids != NO_ID) & (b.ids % every == 0))
                lengths = np.linalg.norm(b.rows[found].astype(float), axis=1)
                columns = [b.uids[found], b.ids[found], b.labels[found], lengths, list(b.rows[found])]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["anchor", "vec_id", "label", "length", "row"])

    return buckets.mapInArrow(pick, _ANCHORS)


def anchor_blocks(anchors: DataFrame) -> DataFrame:
    """Blocks of anchors, each with the score range (``low``, ``high``) of each of its slots."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                one = {name: part.column(name).to_numpy(zero_copy_only=False) for name in ("anchor", "label", "length")}
                file = io.BytesIO()
                slots = int(pc.max(pc.list_value_length(part.column("low"))).as_py())
                ends = {name: [x + [nothing] * (slots - len(x)) for x in part.column(name).to_pylist()]
                        for name, nothing in (("low", MOST), ("high", LEAST))}
                np.savez(file, rows=_filled(part.column("row")), **one, **{k: np.array(v, np.int64) for k, v in ends.items()})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(one["anchor"][0])], pa.int64()), pa.array([file.getvalue()], pa.binary())],
                    ["block", "content"])

    columns = ("anchor", "label", "length", "row", "low", "high")
    return anchors.select(*columns).mapInArrow(pack, "block long, content binary")


class Search:
    """The best rows met so far for every slot of a block of anchors."""

    def __init__(self, content: bytes, keep: int, same_label: bool):
        with np.load(io.BytesIO(content)) as block:
            self.anchors, self.labels, self.lengths, self.rows = (block[k] for k in ("anchor", "label", "length", "rows"))
            self.floor, self.high = block["low"].copy(), block["high"]
        self.floor[self.floor > self.high] = MOST  # such a slot finds nothing
        self.keep, self.same = keep, same_label
        self.directions = _directions(self.rows).astype(float)
        self.focus = np.argsort(-np.abs(self.directions), axis=1, kind="stable")[:, :FOCUS]
        none = np.empty(0, np.int64)
        self.found = dict.fromkeys(("slot", "score", "id", "uid"), none)

    def visit(self, b: Bucket) -> None:
        """Take in what a bucket has."""
        floor = self.floor.min(axis=1, initial=MOST)
        reach = self.lengths * b.longest
        live = np.flatnonzero((floor < MOST) & (floor <= reach * (1 + 1e-9)))
        if not len(live):
            return
        size = max(self.rows.shape[1], b.rows.shape[1])
        wide = [np.pad(x, ((0, 0), (0, size - x.shape[1]))) if x.shape[1] < size else x
                for x in (self.rows, b.rows, b.directions)]
        low, high = self._feasible(live, floor[live], reach[live])
        first, last, coordinate = self._shortest(live, low, high, b)
        width = last - first
        few = np.flatnonzero((width > 0) & (width * FEW < len(b.ids)))
        many = np.flatnonzero(width * FEW >= len(b.ids))
        if len(few):
            owner = np.repeat(few, width[few])
            steps = np.arange(len(owner)) - np.repeat(np.cumsum(width[few]) - width[few], width[few])
            row = b.lists[coordinate[owner], first[owner] + steps].astype(np.int64)
            for r in range(self.focus.shape[1]):
                value = wide[2][row, self.focus[live[owner], r]]
                inside = (value >= low[owner, r]) & (value <= high[owner, r])
                owner, row = owner[inside], row[inside]
            score = np.einsum("ij,ij->i", wide[0][live[owner]].astype(np.int64), wide[1][row].astype(np.int64))
            self._take(live[owner], row, score, b)
        if len(many):
            inside = np.ones((len(many), len(b.ids)), bool)
            for r in range(self.focus.shape[1]):
                value = wide[2][:, self.focus[live[many], r]].T
                inside &= (value >= low[many, r, None]) & (value <= high[many, r, None])
            # By the lengths no partial sum exceeds the bound, so products of this kind are exact.
            bound = reach[live[many]].max()
            kind = np.float32 if bound < 1 << 23 else np.float64 if bound < 1 << 52 else np.int64
            score = (wide[0][live[many]].astype(kind) @ wide[1].astype(kind).T).astype(np.int64)
            self._take_matrix(live[many], inside, score, b)
        self._settle()

    def _feasible(self, live: np.ndarray, floor: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the focus coordinates within which a row can have the cosine that the floor asks for."""
        cosine = np.full(len(live), -1.0)
        cosine[floor == 0] = 0
        positive = floor > 0
        cosine[positive] = np.minimum(floor[positive] / reach[positive] * (1 - 1e-9), 1)
        own = np.arccos(np.clip(np.take_along_axis(self.directions[live], self.focus[live], axis=1), -1, 1))
        around = np.arccos(cosine)[:, None]
        return np.cos(np.minimum(own + around, np.pi)) - ROOM, np.cos(np.maximum(own - around, 0)) + ROOM

    def _shortest(self, live, low, high, b: Bucket) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each anchor's shortest range in a sorted list: its bounds and its coordinate."""
        first, last = np.zeros(len(live), np.int64), np.full(len(live), len(b.ids))
        coordinate = np.zeros(len(live), np.int64)
        for r in range(self.focus.shape[1]):
            focus = self.focus[live, r]
            for f in np.unique(focus[focus < len(b.lists)]):
                who = np.flatnonzero(focus == f)
                values = b.directions[b.lists[f], f]
                start, end = np.searchsorted(values, low[who, r], "left"), np.searchsorted(values, high[who, r], "right")
                shorter = end - start < last[who] - first[who]
                who, start, end = who[shorter], start[shorter], end[shorter]
                first[who], last[who], coordinate[who] = start, np.maximum(start, end), f
        return first, last, coordinate

    def _take(self, anchor: np.ndarray, row: np.ndarray, score: np.ndarray, b: Bucket) -> None:
        """Add verified rows of anchors to the slots that they fit."""
        fits = (b.labels[row] == self.labels[anchor]) == self.same
        fits &= b.uids[row] != self.anchors[anchor]
        anchor, row, score = anchor[fits], row[fits], score[fits]
        for slot in range(self.floor.shape[1]):
            hit = (score >= self.floor[anchor, slot]) & (score <= self.high[anchor, slot])
            self._add(anchor[hit] * self.floor.shape[1] + slot, row[hit], score[hit], b)

    def _take_matrix(self, anchor: np.ndarray, inside: np.ndarray, score: np.ndarray, b: Bucket) -> None:
        inside &= (b.labels == self.labels[anchor][:, None]) == self.same
        inside &= b.uids != self.anchors[anchor][:, None]
        for slot in range(self.floor.shape[1]):
            hit = inside & (score >= self.floor[anchor, slot, None]) & (score <= self.high[anchor, slot, None])
            if len(b.ids) > self.keep and np.count_nonzero(hit) > 4 * self.keep * len(anchor):
                # Only what is as good as the last of the best can be among them.
                last = -np.partition(-np.where(hit, score, LEAST), self.keep - 1, axis=1)[:, self.keep - 1]
                hit &= score >= last[:, None]
            i, row = np.nonzero(hit)
            self._add(anchor[i] * self.floor.shape[1] + slot, row, score[i, row], b)

    def _add(self, slot: np.ndarray, row: np.ndarray, score: np.ndarray, b: Bucket) -> None:
        news = {"slot": slot, "score": score, "id": b.ids[row], "uid": b.uids[row]}
        self.found = {k: np.concatenate([v, news[k]]) for k, v in self.found.items()}

    def _settle(self) -> None:
        """Keep the best of each slot and raise the scores asked for."""
        f = self.found
        order = np.lexsort((f["uid"], f["id"], -f["score"], f["slot"]))
        slot = f["slot"][order]
        rank = np.arange(len(order)) - np.searchsorted(slot, slot, "left")
        order = order[rank < self.keep]
        self.found = {k: v[order] for k, v in f.items()}
        full = rank == self.keep - 1
        at = np.unravel_index(slot[full], self.floor.shape)
        self.floor[at] = np.maximum(self.floor[at], self.found["score"][np.flatnonzero(full[rank < self.keep])])

    def result(self) -> pa.RecordBatch:
        anchor, slot = np.unravel_index(self.found["slot"], self.floor.shape)
        ids = self.found["id"]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.anchors[anchor]), pa.array(slot.astype(np.int32)), pa.array(self.found["uid"]),
             pa.array(ids, mask=ids == NO_ID), pa.array(self.found["score"])],
            ["anchor", "slot", "uid", "vec_id", "score"])


def best_rows(blocks: DataFrame, buckets: DataFrame, keep: int, same_label: bool) -> DataFrame:
    """(anchor, slot, rank, uid, vec_id, score): the ``keep`` best rows for every slot of every anchor.

    Blocks and buckets are stored tables. Each of their parts is paired without a
    shuffle, and a task returns ``keep`` rows for a slot, not one for a row met.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, search = None, None
        for batch in batches:
            for record in batch.to_pylist():
                if search is None or record["block"] != block:
                    if search is not None:
                        yield search.result()
                    block, search = record["block"], Search(record["content"], keep, same_label)
                search.visit(Bucket(record))
        if search is not None:
            yield search.result()

    found = blocks.hint("shuffle_replicate_nl").crossJoin(buckets).mapInArrow(run, _FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80
) -> DataFrame:
    """The best rows of another label whose score is between ``percent`` of a positive's score and that score.

    ``rows`` are those of ``integer_rows``; anchors are those whose id is divisible by
    ``every``, a positive is one of the anchor's ``positives`` best other rows of the
    same label. (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for up to ``negatives`` rows for each anchor and positive.
    """
    buckets = staged(length_buckets(rows), "buckets")
    anchors = staged(anchor_rows(buckets, every), "anchors")
    anyone = anchors.withColumns({"low": F.array(F.lit(LEAST)), "high": F.array(F.lit(MOST))})
    found = staged(best_rows(staged(anchor_blocks(anyone), "blocks"), buckets, positives, True), "positives")

    ranges = found.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    share = F.lit(percent).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    bounded = anchors.join(ranges, "anchor").select(
        *anchors.columns,
        F.transform("p", lambda p: F.ceil(p["score"].cast("decimal(20,0)") * share).cast("long")).alias("low"),
        F.transform("p", lambda p: p["score"]).alias("high"),
    )
    near = best_rows(staged(anchor_blocks(bounded), "blocks"), buckets, negatives, False)
    own = found.select(
        "anchor", F.col("rank").alias("of"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        near.withColumn("of", F.col("slot") + 1).join(own, ["anchor", "of"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
    )
