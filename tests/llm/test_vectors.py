"""Hard negatives, clusters and byte-level BPE against plain versions."""

import collections
import hashlib
import io
import math
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from periodica.llm import byte_bpe, clustering, hard_negatives
from periodica.llm.queries import QUERIES
from tests.llm.cases import documents, nothing, texts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: Names that the operators use inside.
CLASHING = "anchor long, score long, rank int, point int, apex int, cluster int, row int, block int, length int, ids int"
VECTORS = f"vec_id long, embedding array<float>, label int, {CLASHING}"


def vectors(spark, size=8, seed=5):
    """Spread and nearly equal vectors, one very common vector, and every awkward row."""
    rng = random.Random(seed)
    spread = lambda: [rng.gauss(0, 1) for _ in range(size)]
    centre = spread()
    rows = [(i, spread(), rng.randrange(4)) for i in range(150)]
    rows += [(i, [x + rng.gauss(0, 0.02) for x in centre], rng.randrange(3)) for i in range(150, 260)]
    rows += [(i, centre, i % 3) for i in range(260, 420)]
    rows += [(100, spread(), 1), (100, centre, 2), (200, rows[200][1], 1), (300, centre, 0), (7, spread(), 9)]
    rows += [(None, centre, 1), (None, spread(), 1), (500, None, 1), (600, spread(), None), (700, [], 1), (800, [1.0], 2)]
    rows += [(900, [0.0] * size, 1), (901, [0.0] * size, 2), (1000, [float("nan")] * size, 1), (1100, [float("inf")] * size, 1)]
    rows += [(1200, [None, *spread()[1:]], 1), (1300, [-x for x in centre], 1), (-100, spread(), 3), (1400, [*spread(), 1.0], 2)]
    rows += [(1500 + i, [x * 50 for x in spread()], i % 3) for i in range(0, 60, 4)]
    return spark.createDataFrame([(*r, *[None] * 10) for r in rows], VECTORS), rows


def scaled(embedding, scale):
    if embedding is None or any(x is None or not math.isfinite(np.float32(x)) for x in embedding):
        return None
    return [math.floor(float(np.float32(x)) * scale) for x in embedding]


def plain_negatives(rows):
    kept = []
    for i, (vec_id, embedding, label) in enumerate(rows):
        v = scaled(embedding, 256)
        if v is not None and label is not None:
            kept.append((i, vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, v))
    late = lambda i: (i is None, i or 0)
    out = collections.Counter()
    for i, anchor, label, v in kept:
        if anchor is None or anchor % 100:
            continue
        others = sorted(
            ((sum(a * b for a, b in zip(v, w, strict=False)), j, other) for k, j, other, w in kept if k != i),
            key=lambda x: (-x[0], late(x[1])))
        for score, positive, _ in [x for x in others if x[2] == label][:5]:
            near = [x for x in others if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score][:5]
            out.update((anchor, positive, rank, j, score, s) for rank, (s, j, _) in enumerate(near, 1))
    return out


def test_hard_negatives(spark):
    df, rows = vectors(spark)
    prepared = hard_negatives.relabelled(hard_negatives.integer_rows(df))
    got = hard_negatives.hard_negatives(prepared)
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    df, _ = vectors(spark)
    for none in (df.where("false"), df.where("label IS NULL"), df.where("vec_id = 1")):
        rows = hard_negatives.relabelled(hard_negatives.integer_rows(none))
        assert hard_negatives.hard_negatives(rows).collect() == []


def test_rows_too_long_are_refused(spark):
    df = spark.createDataFrame([(1, [3e38, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="31 bits"):
        hard_negatives.integer_rows(df).collect()
    with pytest.raises(Exception, match="component"):
        clustering.integer_vectors(df, size=2).collect()


@pytest.mark.parametrize("spread", [0.05, 0.4, 2.0])
def test_search_over_many_buckets_misses_nothing(spread, monkeypatch):
    """Rows beside and far from the anchors, by buckets that are cut and skipped."""
    monkeypatch.setattr(hard_negatives, "BUCKET", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24)) * 200
    rows = np.floor(centres[rng.integers(6, size=900)] + rng.normal(size=(900, 24)) * 200 * spread).astype(np.int32)
    rows[::13] *= 4
    labels, ids = rng.integers(3, size=900), rng.permutation(900)
    order = np.lexsort((ids, -np.linalg.norm(rows, axis=1)))
    rows, labels, ids = rows[order], labels[order], ids[order]
    lengths = np.linalg.norm(rows.astype(float), axis=1)
    buckets = []
    for n, first in enumerate(range(0, 900, 64)):
        part = slice(first, first + 64)
        table = pa.table({"vec_id": ids[part], "label": labels[part], "length": lengths[part], "row": list(rows[part])})
        buckets.append(hard_negatives.Bucket(hard_negatives.bucket_record(n, table).to_pylist()[0]))
    some = np.flatnonzero(ids % 20 == 0)
    scores = rows[some].astype(np.int64) @ rows.T.astype(np.int64)
    high = np.sort(scores, axis=1)[:, [-4, -30]]
    low = high - np.abs(high) // 5
    file = io.BytesIO()
    np.savez(file, anchor=some, label=labels[some], length=lengths[some], rows=rows[some], low=low, high=high)
    search = hard_negatives.Search(file.getvalue(), 3, False)
    for b in buckets:
        search.visit(b)
    got = sorted(zip(*(search.found[k].tolist() for k in ("slot", "score", "id", "uid")), strict=True))
    want = []
    for i, a in enumerate(some):
        for slot in (0, 1):
            fits = [(-scores[i, r], ids[r], r) for r in range(900)
                    if labels[r] != labels[a] and r != a and low[i, slot] <= scores[i, r] <= high[i, slot]]
            want += [(2 * i + slot, -s, j, r) for s, j, r in sorted(fits)[:3]]
    assert got == sorted(want)


def plain_clusters(rows, size, clusters=16, rounds=3):
    kept = [(vec_id, v) for vec_id, e, _ in rows if (v := scaled(e, 64)) is not None and len(v) == size]
    text = lambda i: "" if i is None else str(i)
    ranked = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{text(r[0])}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in ranked[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for j, vs in members.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(vec_id, *nearest(v)) for vec_id, v in kept]
    per = collections.Counter()
    for _, d, j in found:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return collections.Counter((i, j, d, per[j], sum(per.values()), digest[j]) for i, d, j in found)


@pytest.mark.parametrize("size", [8, 2, 1])
def test_clusters(spark, size):
    df, rows = vectors(spark, size)
    got = clustering.with_inertia(*clustering.cluster_vectors(df, size=size))
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_clusters(rows, size)


def test_clusters_of_few_and_no_vectors(spark):
    df, rows = vectors(spark)
    few = df.where("vec_id IN (5, 6, 300, 301)")
    got = clustering.with_inertia(*clustering.cluster_vectors(few, size=8))
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_clusters([r for r in rows if r[0] in (5, 6, 300, 301)], 8)
    assert clustering.with_inertia(*clustering.cluster_vectors(df.where("false"), size=8)).collect() == []
    assert clustering.with_inertia(*clustering.cluster_vectors(df, size=99)).collect() == []


@pytest.mark.parametrize("flat", [0, 1e-3, 1])
def test_bounds_hold_and_filter(flat):
    """The nearest centroid is never filtered, also where vectors almost lie in a line."""
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(500, 12)) * ([1000] + [1000 * flat] * 11)).astype(np.int64)
    points[::5] = points[0]
    centres = points[rng.permutation(500)[:16]] + rng.integers(-3, 4, size=(16, 12))
    simplex = clustering.Simplex(centres, 6)
    left = clustering.possible(simplex.apexes(points), simplex.apexes(centres))
    exact = np.square(points[:, None] - centres).sum(axis=2)
    assert left[exact == exact.min(axis=1)[:, None]].all()
    assert left.mean() < 0.8


@pytest.fixture(scope="module")
def library():
    import tiktoken

    own = byte_bpe.encoder(RANKS, PATTERN)
    return own, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


PARTS = ["a", "e", "th", "ing", " ", "  ", "\n", "\t", "1", "9", "'s", "'re", "'", "é", "漢", "\U0001f600", "=", "-", "__", "A", "The", "\u3000"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), st.text(max_size=60)))
def test_pieces_encode_as_the_library_does(library, text):
    own, other = library
    text = text.encode("utf-8", "replace").decode()
    ids = list(own.encode(text))
    assert ids == other.encode_ordinary(text)
    flat, sizes = byte_bpe.decoder(RANKS).decode(np.array(ids, np.int32))
    assert flat.tobytes() == text.encode() and sizes.sum() == len(flat)


def test_long_pieces_and_stretches(library, monkeypatch):
    own, other = library
    rng = random.Random(2)
    for text in ("a" * 50_000, "ab" * 30_000, " " * 40_000 + "x", "=" * 30_000 + "漢字" * 9000, "".join(rng.choices("abcdefghij", k=60_000))):
        assert list(own.encode(text)) == other.encode_ordinary(text)
    monkeypatch.setattr(byte_bpe, "STRETCH", 20)
    monkeypatch.setattr(byte_bpe, "BLOCK", 16)
    for _ in range(300):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 200)))
        assert list(own.encode(text)) == other.encode_ordinary(text)


def test_tokens_that_merges_do_not_make():
    """``abc`` has no merge that makes it, so it is a token only as a whole piece."""
    ranks = {bytes([b]): i for i, b in enumerate(b"abcd ")} | {b"ab": 5, b"cd": 6, b"abc": 9, b"abcd": 7}
    codec = byte_bpe.Encoder({**ranks, b"xyz": 8}, r" ?[a-z]+|\s")
    assert list(codec.encode("abc")) == [9] and list(codec.encode("abcd")) == [7]
    assert list(codec.encode("abcabcd")) == codec.merged(b"abcabcd")
    with pytest.raises(ValueError, match="cannot spell"):
        codec.encode("abx")
    with pytest.raises(ValueError, match="no id"):
        byte_bpe.Decoder(ranks).decode(np.array([5, 55]))
    with pytest.raises(ValueError, match="no id 8"):
        byte_bpe.Decoder(ranks).decode(np.array([8, 5]))


def test_byte_bpe_round_trip(spark, library):
    _, other = library
    docs = documents(spark)
    coded = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS)
    got = collections.Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = collections.Counter(
        (r.doc_id, tuple(other.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.select("doc_id", "text").collect())
    assert got == want
    assert byte_bpe.decode(byte_bpe.encode(nothing(spark), RANKS, PATTERN), RANKS).collect() == []
    none = spark.createDataFrame([("x", None)], "doc_id string, ids array<int>")
    assert [tuple(r) for r in byte_bpe.decode(none, RANKS).collect()] == [("x", None, None)]


def test_byte_bpe_query(spark, library, tmp_path):
    _, other = library
    documents(spark, texts(), repeat=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect()}
    digest = lambda data: hashlib.sha256(data).hexdigest()
    for i, text in enumerate(texts()):
        ids = other.encode_ordinary(text or "")
        assert got[i] == (len(ids), digest(" ".join(map(str, ids)).encode()), digest((text or "").encode()))


def test_searches_are_paired_without_a_broadcast(spark):
    blocks = spark.createDataFrame([], "block long, content binary")
    buckets = spark.createDataFrame([], hard_negatives._BUCKETS)
    plan = hard_negatives.best_rows(blocks, buckets, 5, True)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
