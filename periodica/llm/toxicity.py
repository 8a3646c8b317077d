"""Toxicity by weak supervision.

1. A bounded sample of labelled rows gives a lexicon: words and word beginnings that
   set toxic texts apart.
2. Voters look for parts of it: slices of the lexicon per kind of entry, a fixed list
   of insults, and patterns of how often entries occur. Every training text gets a
   vote of each; the corpus is folded to the numbers of each vote pattern.
3. A generative label model explains the patterns by a hidden class: each class has
   its own vote means (the voters' accuracies) and both share a covariance (the
   voters' correlations, so that voters that say the same count once). It is fitted by
   expectation maximisation on the patterns of all training texts; labelled rows of
   the sample hold their class with ``TRUST``.
4. A logistic regression over lexicon entries learns the posterior labels of the
   sample, and scores every text.

Only the id decides whether a row may be learned from; labels, language, source and
id are no inputs of a score. A null text is empty and gets the score of a text
without entries. Rows that repeat an id are scored each; an id with several labels
counts as toxic if one says so. Without usable labels the fixed list alone decides.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import alnum_words, staged

#: Labelled rows that lexicon and classifier are learned from, at most.
SAMPLE = 20_000
#: Lexicon entries, at most.
ENTRIES = 4096
#: Least likelihood ratios of an entry: the classifier weighs it, voters look for it. Chance reaches the
#: second about once in a million entries.
WEIGHED, VOTED = 15.0, 24.0
#: Least shares of toxic texts among those that an entry occurs in, for the classifier and for voters: the entry
#: tells toxic texts, not a language or topic.
PRECISE, SURE = 0.6, 0.9
#: Slices per kind of entry.
SLICES = 3
#: How much a label counts against the votes.
TRUST = 0.98
#: Word beginnings, in bytes.
STEMS = (4, 5, 6)

# Common English insults.
INSULTS = (
    b"clown", b"coward", b"creep", b"disgusting", b"dumb", b"filthy", b"fool", b"freak", b"idiot", b"jerk", b"liar",
    b"loser", b"moron", b"pathetic", b"scum", b"stupid", b"trash", b"ugly", b"vermin", b"worthless",
)


def entries_of(words: set[bytes]) -> set[tuple[int, bytes]]:
    """Words as (0, word) and their beginnings as (length, beginning)."""
    out = {(0, w) for w in words}
    for n in STEMS:
        out.update((n, w[:n]) for w in words if len(w) > n)
    return out


@dataclass
class Lexicon:
    """Entries by kind, each with its place among the classifier's inputs and its voter."""

    places: dict[int, dict[bytes, int]] = field(default_factory=dict)
    voters: list[int] = field(default_factory=list)
    names: list[tuple[int, bytes]] = field(default_factory=list)

    @property
    def n_voters(self) -> int:
        return SLICES * (1 + len(STEMS)) + 3

    def found(self, text: str | None) -> list[int]:
        """Places of the entries that a text has."""
        words = set(alnum_words(text))
        out: list[int] = []
        for n, known in self.places.items():
            mine = words if n == 0 else {w[:n] for w in words if len(w) > n}
            out.extend(known[w] for w in mine & known.keys())
        return out

    def votes(self, text: str | None, found: list[int]) -> int:
        """One bit per voter that calls the text toxic."""
        mask, hits = 0, 0
        for place in found:
            if self.voters[place] >= 0:
                mask |= 1 << self.voters[place]
                hits += 1
        own = SLICES * (1 + len(STEMS))
        if not self._insults.isdisjoint(alnum_words(text)):
            mask |= 1 << own
        for bit, least in ((own + 1, 2), (own + 2, 4)):
            if hits >= least:
                mask |= 1 << bit
        return mask

    _insults = frozenset(INSULTS)


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update(entries_of(set(alnum_words(text.as_py()))))
    keys = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.binary()),
         pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())],
        names=["kind", "entry", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The entries of the sample by how well they tell toxic from clean texts apart; at most ``ENTRIES`` come back."""
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    lexicon = Lexicon({0: {}} | {n: {} for n in STEMS})
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if toxic and clean:
        a, b = F.col("toxic"), F.col("clean")
        share = toxic / (toxic + clean)

        def term(n, expected):
            return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

        inside = term(a, (a + b) * share) + term(b, (a + b) * (1 - share))
        outside = term(toxic - a, (toxic + clean - a - b) * share) + term(clean - b, (toxic + clean - a - b) * (1 - share))
        best = (
            sample.select("text", "toxic").mapInArrow(_count_entries, "kind int, entry binary, toxic long, clean long")
            .groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where((a * clean > b * toxic) & (a >= PRECISE * (a + b)))
            .select("kind", "entry", (2 * (inside + outside)).alias("ratio"), (a / (a + b)).alias("share"))
            .where(F.col("ratio") >= WEIGHED)
            .orderBy(F.desc("ratio"), "kind", "entry").limit(ENTRIES).collect()
        )
        for place, row in enumerate(best):
            kind, entry = row["kind"], bytes(row["entry"])
            lexicon.places[kind][entry] = place
            lexicon.names.append((kind, entry))
            slice_ = sum(entry) % SLICES + SLICES * (0 if kind == 0 else 1 + STEMS.index(kind))
            lexicon.voters.append(slice_ if row["ratio"] >= VOTED and row["share"] >= SURE else -1)
    for word in INSULTS:
        if word not in lexicon.places[0]:
            lexicon.places[0][word] = len(lexicon.names)
            lexicon.names.append((0, word))
            lexicon.voters.append(-1)
    return lexicon


def _vote(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            value = text.as_py()
            counts[lexicon.votes(value, lexicon.found(value))] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts.keys()), pa.int64()), pa.array(list(counts.values()), pa.int64())],
        names=["votes", "texts"])


def vote_patterns(docs: DataFrame, lexicon: Lexicon, text: str) -> list[tuple[int, int]]:
    """(pattern, number of texts) over all rows of ``docs``: at most two to the number of voters."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    counted = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(lambda batches: _vote(batches, shared.value), "votes long, texts long")
        .groupBy("votes").agg(F.sum("texts").alias("texts"))
    )
    return [(r["votes"], r["texts"]) for r in counted.collect()]


@dataclass
class LabelModel:
    """Class-conditional vote means with a shared covariance."""

    weights: np.ndarray
    bias: float
    means: np.ndarray
    covariance: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of the toxic class for rows of votes."""
        return 1 / (1 + np.exp(-np.clip(votes @ self.weights + self.bias, -30, 30)))


def _bits(masks: list[int], n: int) -> np.ndarray:
    return ((np.asarray(masks, np.int64)[:, None] >> np.arange(n)) & 1).astype(float)


def fit_label_model(
    patterns: list[tuple[int, int]], labelled: list[tuple[int, int, int]], n_voters: int, rounds: int = 50
) -> LabelModel:
    """Expectation maximisation over (pattern, texts), and (pattern, label, texts) of labelled rows.

    It begins with the texts that at least two voters call toxic. Labelled rows weigh
    as much as all others together, so that voters which merely agree with each
    other do not become the class.
    """
    masks = [m for m, _ in patterns] + [m for m, _, _ in labelled]
    votes = _bits(masks, n_voters)
    count = np.asarray([float(n) for _, n in patterns] + [float(n) for _, _, n in labelled])
    fixed = np.asarray([np.nan] * len(patterns) + [float(y) for _, y, _ in labelled])
    given = ~np.isnan(fixed)
    if given.any() and not given.all():
        count[given] *= max(1.0, count[~given].sum() / count[given].sum())
    toxic = (votes.sum(axis=1) >= 2).astype(float)
    toxic[given] = np.where(fixed[given] == 1, TRUST, 1 - TRUST)
    model = None
    for _ in range(rounds):
        mass = np.asarray([(count * (1 - toxic)).sum() + 1, (count * toxic).sum() + 1])
        means = np.stack([((count * (1 - toxic)) @ votes + 0.05) / mass[0], ((count * toxic) @ votes + 0.5) / mass[1]])
        spread = np.zeros((n_voters, n_voters))
        for share, mean in ((1 - toxic, means[0]), (toxic, means[1])):
            off = votes - mean
            spread += (off * (count * share)[:, None]).T @ off
        covariance = spread / mass.sum() + 0.01 * np.eye(n_voters)
        weights = np.linalg.solve(covariance, means[1] - means[0])
        prior = mass[1] / mass.sum()
        bias = -0.5 * weights @ (means[0] + means[1]) + np.log(prior / (1 - prior))
        model = LabelModel(weights, float(bias), means, covariance, float(prior))
        before, toxic = toxic, model.posterior(votes)
        odds = np.where(fixed[given] == 1, TRUST / (1 - TRUST), (1 - TRUST) / TRUST)
        toxic[given] = toxic[given] * odds / (toxic[given] * odds + 1 - toxic[given])
        if not len(toxic) or np.abs(before - toxic).max() < 1e-6:
            break
    return model


def fit_classifier(rows: list[list[int]], target: np.ndarray, n: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised logistic regression on 0/1 inputs, by full-batch Adagrad."""
    flat = np.fromiter((p for r in rows for p in r), np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, bias, squares, bias_square = np.zeros(n), -2.0, np.full(n, 1e-8), 1e-8
    for _ in range(rounds):
        logit = np.bincount(owner, weights[flat], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target
        gradient = np.bincount(flat, error[owner], n) + 0.01 * weights
        squares += gradient**2
        weights -= 0.5 * gradient / np.sqrt(squares)
        bias_gradient = error.sum()
        bias_square += bias_gradient**2
        bias -= 0.5 * bias_gradient / np.sqrt(bias_square)
    return weights, float(bias)


@dataclass
class Classifier:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        logit = self.bias + sum(self.weights[p] for p in self.lexicon.found(text))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def first_rows(found: DataFrame, rows: int) -> DataFrame:
    """The first rows by hashes of ``labelled_id`` and then of ``text``, of which there are few distinct ids.

    Ids are counted without their texts; only the id at the limit can be cut.
    """
    key = F.xxhash64("labelled_id")
    counts = found.groupBy("labelled_id").agg(F.count("*").alias("n")).select("labelled_id", "n", key.alias("h"))
    left = rows
    for row in counts.orderBy("h", "labelled_id").collect():
        if row["n"] > left:
            last = F.lit(row["labelled_id"]).cast(found.schema["labelled_id"].dataType)
            before = found.where((key < row["h"]) | ((key == row["h"]) & (F.col("labelled_id") < last)))
            cut = found.where(F.col("labelled_id") == last).orderBy(F.xxhash64("text"), "text").limit(left)
            return before.union(cut) if left else before
        left -= row["n"]
    return found


def train(
    docs: DataFrame, labels: DataFrame, trainable: Column, doc_id: str = "doc_id", text: str = "text",
    toxic: str = "toxic", sample_rows: int = SAMPLE,
) -> Classifier:
    """A classifier learned from rows where ``trainable`` (a column of the id) holds.

    At most ``sample_rows`` labelled rows, the first by a hash of their id and then one
    of their text, become the sample; votes are taken from all training texts.
    """
    kind = docs.schema[doc_id].dataType
    usable = docs.where(trainable)
    named = (
        labels.select(F.col(doc_id).cast(kind).alias("labelled_id"), (F.col(toxic) > 0).cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("labelled_id").isNotNull())
        .groupBy("labelled_id").agg(F.max("toxic").alias("toxic"))
    )
    # Only training ids are drawn from, by the same rule as the documents.
    drawn = (
        named.withColumn(doc_id, F.col("labelled_id")).where(trainable).select("labelled_id", "toxic")
        .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample_rows)
    )
    found = usable.select(F.col(doc_id).alias("sample_id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(drawn), F.col("sample_id") == F.col("labelled_id"))
    sample = staged(first_rows(found, sample_rows).select("text", "toxic"), "labelled-sample")
    lexicon = learn_lexicon(sample)
    patterns = vote_patterns(usable, lexicon, text)

    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, votes = [], []
            for value in batch.column(0).to_pylist():
                found.append(shared.value.found(value))
                votes.append(shared.value.votes(value, found[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), pa.array(votes, pa.int64()), batch.column(1)],
                names=["found", "votes", "toxic"])

    rows = sample.mapInArrow(describe, "found array<int>, votes long, toxic int").collect()
    labelled = [(m, y, n) for (m, y), n in Counter((r["votes"], r["toxic"]) for r in rows).items()]
    model = fit_label_model(patterns, labelled, lexicon.n_voters)
    n = len(lexicon.names)
    if not rows or not any(r["toxic"] for r in rows):
        weights = np.zeros(n)
        weights[[lexicon.places[0][w] for w in INSULTS]] = 3.0
        return Classifier(lexicon, weights, -2.0)
    target = model.posterior(_bits([r["votes"] for r in rows], lexicon.n_voters))
    odds = np.where(np.asarray([r["toxic"] for r in rows]) == 1, TRUST / (1 - TRUST), (1 - TRUST) / TRUST)
    target = target * odds / (target * odds + 1 - target)
    weights, bias = fit_classifier([r["found"] for r in rows], target, n)
    return Classifier(lexicon, weights, bias)


def score(docs: DataFrame, classifier: Classifier, held_out: Column, threshold: float = 0.7, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, classifier: Classifier, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py()) < threshold for t in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
