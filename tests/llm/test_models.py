"""Language model, decontamination, toxicity, near dedup and packing against plain versions."""

import collections
import math
import random
import struct
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from periodica.llm import decontaminate, kneser_ney, minhash, packing, toxicity
from periodica.llm.common import crc_remainder_column
from tests.llm.cases import documents, nothing, plain_words, texts, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_model(train):
    counts, triples = collections.Counter(), collections.Counter()
    for text in train:
        tokens = [*plain_words(text), "end"]
        counts.update(tokens)
        padded = ["begin", "begin", *tokens]
        triples.update(zip(padded, padded[1:], tokens, strict=False))
    pairs = collections.Counter()
    for (_, v, w), n in triples.items():
        pairs[v, w] += n if v == "begin" else 1
    follow = collections.Counter(w for _, w in pairs)

    def contexts(table):
        sums, kinds = collections.Counter(), collections.defaultdict(lambda: [0] * 4)
        for key, n in table.items():
            sums[key[:-1]] += n
            kinds[key[:-1]][min(n, 3)] += 1
        return sums, kinds

    def discounts(values):
        n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        return [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] and n[0] else 0.5 for k in (1, 2, 3)]

    orders = [(t, *contexts(t), discounts(t.values())) for t in (pairs, triples)]
    low = discounts(follow.values())
    total, types = len(pairs), len(counts)
    mass = sum(low[min(v, 3)] for v in follow.values()) / total

    def probability(u, v, w):
        p = max(follow[w] - low[min(follow[w], 3)], 0) / total + mass / (types + 1)
        for context, (table, sums, kinds, cut) in zip(((v,), (u, v)), orders, strict=True):
            if sums[context]:
                n = table[*context, w]
                kept = sum(cut[k] * kinds[context][k] for k in (1, 2, 3)) / sums[context]
                p = max(n - cut[min(n, 3)], 0) / sums[context] + kept * p
        return p

    return counts, probability


def test_language_model(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10
    counts, probability = plain_model([r.text for r in rows if fold(r.doc_id)])
    total, types = sum(counts.values()), len(counts)
    got = collections.Counter()
    for r in kneser_ney.train_and_score(docs).collect():
        assert r.held_out == (fold(r.doc_id) == 0) and r.train_tokens == total
        got[r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)] += 1
    want = collections.Counter()
    for r in rows:
        tokens = [*plain_words(r.text), "end"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        padded = ["begin", "begin", *tokens]
        score = sum(math.log10(probability(*t)) for t in zip(padded, padded[1:], tokens, strict=False))
        want[r.doc_id, len(tokens), sum(counts[w] > 0 for w in tokens), round(base, 6), round(score, 6)] += 1
    assert got == want
    some = plain_words(rows[30].text)
    for context in (("begin", "begin"), ("begin", some[0]), tuple(some[:2]), ("never seen", some[0]), ("no", "never seen")):
        assert sum(probability(*context, w) for w in [*counts, "never seen"]) == pytest.approx(1)


def test_language_model_without_rows(spark):
    assert kneser_ney.train_and_score(nothing(spark)).count() == 0
    model = kneser_ney.train(nothing(spark))
    row = kneser_ney.score(documents(spark, ["a b"], repeat=False), model, F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_model_of_many_buckets_opens_few_files(spark, tmp_path, monkeypatch):
    import os

    monkeypatch.setattr(kneser_ney, "OPEN", 64)
    buckets, rng = 2000, np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64))
    bucket = kneser_ney._ranges(hashes, buckets)
    bases = [0]
    for b in range(buckets):
        mine = hashes[bucket == b]
        kneser_ney._write(f"file://{tmp_path}/words/{b}", mine.astype("<u8"))
        kneser_ney._write_parts(f"file://{tmp_path}/counts/{b}", kneser_ney._small(np.arange(len(mine)) + 5_000_000_000))
        kneser_ney._write_parts(f"file://{tmp_path}/stats/{b}", kneser_ney._small(np.ones(len(mine), np.int64)) * 5)
        bases.append(bases[-1] + len(mine))
    model = kneser_ney.Model(f"file://{tmp_path}", buckets, buckets, bases, 1, 1, [0.5] * 3, [0.5] * 3, [0.5] * 3, 1, (0,) * 4, 1.0)
    scorer, before = kneser_ney._Scorer(model), len(os.listdir("/proc/self/fd"))
    asked = np.concatenate([hashes[rng.permutation(len(hashes))], hashes[:5] + np.uint64(1)])
    ids = scorer.words.ids(asked)
    assert (hashes[ids[:-5]] == asked[:-5]).all() and (ids[-5:] == -1).sum() >= 4
    counts, _ = scorer.of_words(ids[:-5])
    assert counts.min() == 5_000_000_000
    assert len(os.listdir("/proc/self/fd")) - before <= 64


def test_counts_beyond_32_bits(tmp_path):
    most = 2**32 - 1
    piece = {"bucket": 0, "keys": kneser_ney._pack_keys(np.array([7, 9], np.uint64)), "values": kneser_ney._pack(np.array([most, 1], np.uint64))}
    pieces = pd.DataFrame([piece, piece])
    out = kneser_ney._merge_words(pieces, f"file://{tmp_path}")
    assert out["tokens"][0] == 2 * most + 2
    stored = kneser_ney._parts(kneser_ney._Arrays(f"file://{tmp_path}").get("counts", 0, "u1"), kneser_ney._SMALL)
    assert kneser_ney._small_at(stored, np.arange(2)).tolist() == [2 * most, 2]
    pair, word, count = np.array([5, 5, 9], np.uint64), np.array([1, 2, 1], np.uint32), np.array([most, 254, 255])
    rows = [p.to_pandas() for p in kneser_ney._triple_pieces(pair, word, count, np.zeros(3, np.int64))]
    kneser_ney._merge_triples_of(pd.concat(rows * 2), f"file://{tmp_path}", 3, 1)
    contexts = kneser_ney._Contexts(kneser_ney._Arrays(f"file://{tmp_path}").get("contexts", 0, "u1"))
    assert contexts.keys.tolist() == [5, 9] and contexts.words.tolist() == [1, 2, 1]
    assert kneser_ney._small_at(contexts.counts, np.arange(3)).tolist() == [2 * most, 508, 510]


def test_contexts_hold_what_follows_them():
    rng = np.random.default_rng(6)
    sizes = np.concatenate((rng.integers(1, 40, 500), [70_000, 1, 1, 16, 15], rng.integers(1, 3, 300)))
    keys = np.unique(rng.integers(0, 2**63, len(sizes), dtype=np.uint64))
    pair = np.repeat(keys, sizes)
    word = np.concatenate([np.sort(rng.choice(200_000, n, replace=False)) for n in sizes]).astype(np.uint32)
    count = rng.choice([1, 2, 3, 254, 255, 5_000_000_000], len(pair))
    parts = kneser_ney._Contexts.parts(pair, word, count)
    contexts = kneser_ney._Contexts(np.concatenate([
        np.asarray([len(parts), *(p.nbytes for p in parts)], "<u8").view("u1"),
        *(np.concatenate((p.ravel().view("u1"), np.zeros(-p.nbytes % 8, "u1"))) for p in parts)]))
    at = rng.permutation(len(keys))
    low, end = contexts.start(at), contexts.start(at + 1)
    assert (end - low == sizes[at]).all()
    for row, a, b in zip(contexts.stats(at, low, end), low, end, strict=True):
        mine = count[a:b]
        assert row.tolist() == [(mine == 1).sum(), (mine == 2).sum(), (mine > 2).sum(), mine.sum()]
    pick = rng.integers(0, 2**16, len(at)) % (end - low) + low
    assert (contexts.count(low, end, word[pick]) == count[pick]).all()
    assert (contexts.count(low, end, np.full(len(at), 200_001)) == 0).all()


def test_arrays_of_a_store_that_cannot_be_mapped(tmp_path):
    kneser_ney._write(f"file://{tmp_path}/words/0", np.arange(5, dtype="<u8"))
    arrays = kneser_ney._Arrays(f"file://{tmp_path}")
    arrays.local = False
    assert arrays.get("words", 0, "<u8").tolist() == [0, 1, 2, 3, 4] and not isinstance(arrays.get("words", 0, "<u8"), np.memmap)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    assert (kneser_ney._unpack_keys(kneser_ney._pack_keys(keys)) == keys).all()
    values = rng.integers(0, 2**31, 77).astype(np.uint32)
    assert (kneser_ney._unpack(kneser_ney._pack(values), np.uint32) == values).all()


def alnum(text):
    out, now = [], ""
    for c in text or "":
        c = c.lower() if c.isascii() else c
        if ord(c) >= 128 or c.isalnum():
            now += c
        elif now:
            out.append(now)
            now = ""
    return [*out, now] if now else out


def plain_contamination(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = alnum(text), set(), set()
        for item_id, body in items:
            v = alnum(body)
            n = min(13, len(v))
            windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add(item_id)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark):
    rng = random.Random(5)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate((1, 2, 5, 12, 13, 14, 30, 60))]
    items += [(8, None), (9, ""), (10, items[6][1].upper()), (None, items[5][1]), (6, items[6][1]), (11, "é漢 ü—x")]
    docs = [(i, t) for i, t in enumerate(texts())]
    for k in range(30):
        body = words(rng, rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            source = alnum(rng.choice([x for _, x in items if x]))
            at, cut = rng.randrange(len(body) + 1), rng.choice([len(source), 13, 12, 20])
            body[at:at] = source[:cut]
        docs.append((100 + k, rng.choice([" ", ", ", "-"]).join(body)))
    docs.append((None, items[7][1]))
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, row string, window string")
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, body string")
    got = decontaminate.contamination(frame, bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=str) == sorted(
        plain_contamination(docs, items), key=str)
    assert decontaminate.contamination(frame, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(frame.where("false"), bench).count() == 0


def plain_components(rows, size, percent):
    sets = []
    for _, text in rows:
        w = plain_words(text)
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        known = smallest.get(find(i))
        smallest[find(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return sorted(((d, len(sets[i]), smallest[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("size", "block"), [(2, 500_000), (5, 500_000), (2, 300)])
def test_near_duplicates(spark, monkeypatch, size, block):
    # With small blocks one group is dealt to pairs of blocks.
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(docs, size, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == plain_components(rows, size, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(nothing(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, 50), (50, 30), (7, 7), (1, 50)] + [(1000, 1000 + k) for k in range(1, 40)]
    rng.shuffle(edges)
    got = dict(minhash.components(spark.createDataFrame(edges, "a long, b long"), "test").collect())
    assert got == {i: 100 for i in range(101, 161)} | {50: 1, 30: 1} | {1000 + k: 1000 for k in range(1, 40)}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    union = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = np.sort(union[:900]), np.sort(union[100:])
    share = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(share - 0.8) < 0.12
    first, runs = minhash.permutations()
    assert len(set(first.tolist())) == minhash.UNIVERSE and (runs[1][:-1] == runs[0][1:]).all()


def test_packing(spark):
    from tokenizers import Tokenizer

    docs = documents(spark)
    plain = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack_documents(docs, TOKENIZER, 2, 256).collect()
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), 256):
            part = ids[at : at + 256]
            want[r.doc_id, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
    assert collections.Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == want
    bins = collections.defaultdict(list)
    for p in pieces:
        bins[p.sequence_id].append((p.offset, p.length))
    for held in bins.values():
        ends = [a + n for a, n in sorted(held)]
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert len(bins) <= sum(p.length for p in pieces) / 256 * 1.1 + 1
    assert packing.pack_documents(nothing(spark), TOKENIZER, 2).count() == 0


def test_packing_worker_remembers_within_a_task_only(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} some more words") for i in range(50)], "doc_id long, text string").coalesce(1)

    def held(batches):
        n = sum(len(e.known) for _ in batches for e in packing._ENCODERS.values())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["held"])

    assert packing.token_pieces(docs, TOKENIZER, 2).count() == 50
    assert all(r.held <= 1 for r in spark.range(0, 8, 1, 8).mapInArrow(held, "held long").collect())

    plain, small = packing.ChunkEncoder(TOKENIZER), packing.ChunkEncoder(TOKENIZER)
    texts = [[f"w{k % 7} w{j} w{j * j}." for j in range(k, k + 10)] for k in range(60)]
    want = [list(plain.encode(part)) for part in texts]
    monkeypatch.setattr(packing, "CACHED", 60)
    for part, ids in zip(texts, want, strict=True):
        assert list(small.encode(part)) == ids
        assert len(small.known) <= 60 and len(small.older) <= 60
    small.forget()
    assert len(small.known) == 1 and not small.older


def test_chunks_encode_like_whole_texts():
    encoder = packing.ChunkEncoder(TOKENIZER)
    odd = ["", " ", "Hello, World. don't I'll 's,", "a<|startoftext|>b <|STARTOFTEXT|> x", "<|endoftext|>", "İstanbul, ΑΣ. ß., ... ,",
           "é, ñ. é. ﬁ", "tab\tnew\nline\r\x0b\x0c\x1c\x85 end", "12,3.4 a1b2, ½. ².", "漢字 漢, Кот,", "x" * 300 + ". ", *map(lambda t: t or "", texts())]
    whole = [np.asarray(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
    assert list(encoder.encode(odd)) == whole and list(encoder.encode(odd)) == whole


def test_plain_chunks_skip_the_whole_tokenizer(monkeypatch):
    encoder = packing.ChunkEncoder(TOKENIZER)
    assert encoder.cuts_here
    others: list[str] = []
    through = encoder._encode_others
    monkeypatch.setattr(encoder, "_encode_others", lambda chunks: through(others.extend(chunks) or chunks))

    def whole(text):
        return np.asarray(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    rng = random.Random(2)
    letters = "".join(c for c in packing.LETTERS if packing._PLAIN(c.lower()))
    plain = ["don't", "inheedin!!", "x's're'", "12.5,", '"b55e8a"', "'sé'll", "###", *letters, *(
        "".join(rng.choices(letters + "abcst'" * 40 + "019.,!$~", k=rng.randint(1, 12))) for _ in range(1000))]
    assert list(encoder.encode([f" {c}\n{c}" for c in plain])) == [whole(f" {c}\n{c}") for c in plain]
    assert not others
    odd = ["e\u0301", "a<|b", "x\x0by", "½", "\u0130", "кот", "a\u00a0b", "\x1c"]
    assert list(encoder.encode(odd)) == [whole(c) for c in odd]
    assert sorted(others) == sorted(odd)
    # A tokenizer that cuts in another way takes every chunk itself.
    encoder.forget()
    encoder.cuts_here = False
    assert list(encoder.encode(["one two."])) == [whole("one two.")]
    assert sorted(others[len(odd):]) == ["one", "two."]
    assert list(encoder.encode([])) == [] and list(encoder.encode([""])) == [b""]


def test_packing_slices_hold_all_rows(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 10)
    texts = ["", "a" * 4, "é" * 3, "b", "c" * 25, "", "d", "e" * 10, "f"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(range(9)), pa.array(texts)], names=["doc_id", "row", "text"])
    held = [p.column(2).to_pylist() for p in packing.slices(batch)]
    assert [t for h in held for t in h] == texts and len(held) < len(texts)
    assert all(len(h) == 1 or sum(len(t.encode()) for t in h) <= 10 for h in held)
    assert list(packing.slices(batch.slice(0, 0))) == []


def test_first_fit_decreasing():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    free: list[int] = []
    for size, b, at in zip(sizes, bins, offsets, strict=True):
        place = next((i for i, f in enumerate(free) if f >= size), len(free))
        free += [100] * (place == len(free))
        assert (b, at) == (place, 100 - free[place])
        free[place] -= size
    assert packing.first_fit_decreasing([], 5) == ([], [])
    with pytest.raises(ValueError, match="does not fit"):
        packing.first_fit_decreasing([6], 5)


def toxic_corpus(spark, n=900):
    rng = random.Random(11)
    bad = ["".join(w) for w in (("gra", "mpol"), ("vex", "ulo"), ("tor", "bane"), ("sku", "lker"))]
    docs, labels = [], []
    for i in range(n):
        body, toxic = words(rng, rng.randint(5, 60)), rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(2, 4)):
                body.insert(rng.randrange(len(body)), rng.choice(bad) + (rng.choice(["", "es", "ing"])))
        docs.append((i, " ".join(body), "en", "s", len(body)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    docs += [(n, None, "en", "s", 0), (n + 1, "", "en", "s", 0)]
    labels += [(n, None, None), (None, 1, 1), (0, 1, 0), (0, 1, 0)]
    frame = spark.createDataFrame([(*d, "c", "d") for d in docs], "doc_id long, text string, lang string, source string, n_chars long, votes string, toxic string")
    truth = {d[0]: any(b in (d[1] or "") for b in bad) for d in docs}
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_toxicity(spark):
    docs, labels, truth = toxic_corpus(spark)
    held_out = crc_remainder_column(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels, ~held_out)
    rows = toxicity.score(docs, model, held_out).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    mine = [r for r in rows if r.held_out]
    assert {r.doc_id for r in mine} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == truth[r.doc_id] for r in mine) / len(mine) > 0.97
    clean = toxicity.without_toxic(docs, model)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in rows if not r.predicted}
    # Labels of held-out rows change nothing.
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, turned, ~held_out), held_out).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in rows})


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    rows = [(i, f"text {k} of {i}", i % 2) for i in range(30) for k in range(10)]
    found = spark.createDataFrame(rows, "labelled_id long, text string, toxic int")
    first = {tuple(r) for r in toxicity.first_rows(found, 95).collect()}
    assert len(first) == 95 and {tuple(r) for r in toxicity.first_rows(found.repartition(7), 95).collect()} == first
    assert toxicity.first_rows(found, 90).count() == 90 and toxicity.first_rows(found, 400).count() == 300
    staged, sizes = toxicity.staged, []
    monkeypatch.setattr(toxicity, "staged", lambda df, name: sizes.append((out := staged(df, name)).count()) or out)
    toxicity.train(found.select(F.col("labelled_id").alias("doc_id"), "text"), found.select(
        F.col("labelled_id").alias("doc_id"), "toxic"), F.lit(True), sample_rows=20)
    assert sizes == [20]


def test_toxicity_without_labels(spark):
    docs, labels, _ = toxic_corpus(spark, 30)
    model = toxicity.train(docs, labels.where("false"), F.lit(True))
    assert model.score("you idiot, what a stupid moron") > 0.7 > model.score("a kind word") and 0 <= model.score(None) <= 1
    assert toxicity.score(docs.where("false"), model, F.lit(True)).count() == 0


def test_label_model_discounts_correlated_votes():
    rng = np.random.default_rng(4)
    hidden = rng.random(4000) < 0.3
    good = [np.where(rng.random(4000) < 0.9, hidden, ~hidden) for _ in range(2)]
    weak = np.where(rng.random(4000) < 0.7, hidden, ~hidden)
    votes = np.stack([*good, weak, weak, weak], axis=1)
    masks = [int((v << np.arange(5)).sum()) for v in votes.astype(int)]
    known = collections.Counter((m, int(y)) for m, y in zip(masks[:400], hidden[:400], strict=True))
    model = toxicity.fit_label_model(
        list(collections.Counter(masks).items()), [(m, y, n) for (m, y), n in known.items()], 5)
    # Three voters that always agree count less than one good one.
    assert 0 < model.weights[2:].sum() < model.weights[0]
    agree = (model.posterior(votes.astype(float)) > 0.5) == hidden
    assert agree.mean() > 0.85
