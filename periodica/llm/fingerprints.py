"""Homomorphic multiset fingerprints of texts.

Every paragraph (line that is not empty) is hashed to a wide vector, and a text's
fingerprint is the sum of its paragraphs' vectors modulo powers of two. The sum does
not depend on the order of paragraphs, and paragraphs can be added or taken away
(``added``, ``removed``) without the rest of the text.

The vector has two parts. Eight lanes modulo 2**32 are the paragraph's SHA-256: they
tell multisets of paragraphs apart. ``2 * HALF`` lanes modulo 2**32 add up, over the
distinct features of the paragraph, one bit of the feature's hash each, next to a lane
that counts the features. Features are the pairs of words that begin at every word, the
last word standing alone, with one space between them. A paragraph of up to
``FEW`` words has its runs of three characters as well, one of more words a sixteenth
fewer of them for every further word (those whose hash says so, so that texts with
about as many words keep the same ones). Centred at their mean those lanes are
a random projection of the features' multiset, so the cosine of two fingerprints
estimates that of the texts: halves in common give about a half, unrelated texts
about nothing.

A null text is the empty text, whose fingerprint is zero; two empty texts have
likeness 1, an empty and another one 0. Rows that repeat an id are ordered by their
text. An empty table gives no rows. Other columns are not read. Only column functions
are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica.llm.common import text_of

#: Longs that hold two likeness lanes each.
HALF = 64
#: Words up to which all of a paragraph's runs of three characters count; with 16 more words none does.
FEW = 8
#: White space other than a single space between words.
_WIDE = r"\s{2,}|[\t\x0B\f\r]"
#: A word; the first group is the word with its successor.
_PAIR = r"(?=(\S++(?:\s\S++)?))\S++"
#: A character; the first group is the run of three that it begins.
_RUN = r"(?s)(?=(.{3}))."
_EQUAL = 8
_LOW = 0xFFFFFFFF
_NAMES = [f"e{i}" for i in range(_EQUAL)] + [f"s{i}" for i in range(HALF)] + ["features"]


def _paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda p: p != "")


def _features(paragraph: Column, pairs: Column) -> Column:
    """The distinct features of a paragraph with the given word pairs, never none."""
    runs = F.regexp_extract_all(paragraph, F.lit(_RUN), F.lit(1))
    more = F.size(pairs) - FEW
    # Not by the hash whose bits are added up.
    some = F.filter(runs, lambda run: F.pmod(F.crc32(run.cast("binary")), F.lit(16)) >= more)
    found = F.when(more >= 16, pairs).when(F.size(pairs) > 0, F.concat(pairs, some))
    return F.array_distinct(found.otherwise(F.array(paragraph)))


def fingerprint_lanes(texts: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """The summed lanes of every row of ``texts``, by ``keys``; a text without paragraphs gives zeros.

    If ``texts`` is already dealt out by some of the keys, nothing is shuffled.
    """
    digest = F.sha2(F.col("p"), 256)
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"e{i}") for i in range(_EQUAL)]
    # Digest and features are made per paragraph, below the explode that takes the features apart.
    paragraphs = texts.select(*keys, F.explode_outer(_paragraphs(F.col(text))).alias("p")).select(
        *keys, *parts, F.regexp_replace("p", _WIDE, " ").alias("p")).withColumn(
        "pairs", F.regexp_extract_all("p", F.lit(_PAIR), F.lit(1))).select(
        *keys, *(f"e{i}" for i in range(_EQUAL)), _features(F.col("p"), F.col("pairs")).alias("features"))
    paragraphs = paragraphs.select(*keys, *(f"e{i}" for i in range(_EQUAL)), F.posexplode_outer("features").alias("nth", "feature"))
    # A text without paragraphs has one row without a feature, which adds nothing.
    found = F.col("feature").isNotNull()
    paragraphs = paragraphs.withColumn("h", F.when(found, F.xxhash64("feature")).otherwise(F.lit(0).cast("long")))
    paragraphs = paragraphs.withColumn("h2", F.when(found, F.xxhash64("h")).otherwise(F.lit(0).cast("long")))
    once = F.col("nth") == 0
    pair = F.lit(0x0000000100000001)
    sums = [F.sum(F.when(once, F.col(f"e{i}"))) for i in range(_EQUAL)]
    sums += [F.sum(F.shiftrightunsigned("h" if i < 32 else "h2", i % 32).bitwiseAND(pair)) for i in range(HALF)]
    sums.append(F.count(F.when(F.col("e0").isNotNull(), F.col("h"))))
    named = [F.coalesce(s, F.lit(0)).alias(n) for s, n in zip(sums, _NAMES, strict=True)]
    return paragraphs.groupBy(*keys).agg(*named)


def modular(lanes: Column, which: str) -> Column:
    """A lane of summed lanes, brought back below its modulus."""
    value = lanes[which]
    return value.bitwiseAND(_LOW) if which.startswith("e") or which == "features" else value


def fingerprint(lanes: Column) -> Column:
    """The hexadecimal fingerprint of a struct of summed lanes."""
    own = [F.lpad(F.lower(F.hex(modular(lanes, n))), 16 if n.startswith("s") else 8, "0") for n in _NAMES]
    return F.concat(*own)


def _vector(lanes: Column) -> Column:
    """The centred likeness lanes as an array of doubles."""
    both = F.array(*(lanes[f"s{i}"] for i in range(HALF)))
    halves = F.concat(
        F.transform(both, lambda x: x.bitwiseAND(_LOW)), F.transform(both, lambda x: F.shiftrightunsigned(x, 32)))
    return F.transform(halves, lambda x: 2.0 * x - lanes["features"])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """The cosine of two fingerprints' likeness lanes, between 0 and 1; exactly 1 if they are equal."""
    va, vb = _vector(a), _vector(b)
    cosine = F.try_divide(_dot(va, vb), F.sqrt(_dot(va, va)) * F.sqrt(_dot(vb, vb)))
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0)))))


def _wrapped(x: Column, y: Column, name: str, sign: int) -> Column:
    if name.startswith("s"):
        low = (x.bitwiseAND(_LOW) + sign * y.bitwiseAND(_LOW)).bitwiseAND(_LOW)
        high = (F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)).bitwiseAND(_LOW)
        return F.shiftleft(high, 32).bitwiseOR(low)
    return (x + sign * y).bitwiseAND(_LOW)


def added(a: Column, b: Column) -> Column:
    """The lanes of both multisets together."""
    return F.struct(*(_wrapped(a[n], b[n], n, 1).alias(n) for n in _NAMES))


def removed(a: Column, b: Column) -> Column:
    """The lanes of ``a`` after the paragraphs of ``b`` are taken away."""
    return F.struct(*(_wrapped(a[n], b[n], n, -1).alias(n) for n in _NAMES))


def id_splits(ids: DataFrame, blocks: int) -> list:
    """Up to ``blocks - 1`` ids that cut the rows into ranges of about equal numbers."""
    shares = [i / blocks for i in range(1, blocks)]
    if not shares:
        return []
    found = ids.agg(F.percentile_approx("id", shares, max(10_000, 20 * blocks)).alias("q")).first()["q"]
    return sorted(set(found or []))


def block_of(value: Column, splits: list) -> Column:
    """The number of splits at or below a value, found in two levels of square-root size."""
    if not splits:
        return F.when(value.isNull(), F.lit(-1)).otherwise(F.lit(0))
    width = max(1, round(len(splits) ** 0.5))
    parts = [splits[i : i + width] for i in range(0, len(splits), width)]
    heads = F.array(*(F.lit(p[0]) for p in parts))
    count = F.size(F.filter(heads, lambda s: s <= value))
    bodies = F.array(*(F.array(*(F.lit(s) for s in p)) for p in parts))
    inner = F.size(F.filter(F.get(bodies, count - 1), lambda s: s <= value))
    return F.when(value.isNull(), F.lit(-1)).when(count == 0, F.lit(0)).otherwise((count - 1) * width + inner)


def edited_fingerprints(docs: DataFrame, blocks: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last half (rounded down) replaced by as many first code
    points, or all, of the next document by descending id; after the last comes the
    first. Documents are dealt once, into ranges of ids of about equal numbers; the
    first document of a range goes to the preceding one as well, so that neighbours
    meet there, and everything else happens without another shuffle.
    """
    rows = docs.select(F.col(doc_id).alias("id"), text_of(F.col(text)).alias("text"))
    splits = id_splits(rows.select("id"), blocks)
    placed = rows.select(
        block_of(F.col("id"), splits).alias("block"), F.struct("id", F.xxhash64("text").alias("h")).alias("order"), "text")

    # The first document of each range and the range before it: as many rows as there are ranges.
    down = Window.orderBy(F.desc("block"))
    heads = placed.groupBy("block").agg(F.max("order").alias("top")).select(
        "block", "top", F.coalesce(F.lag("block").over(down), F.min("block").over(Window.partitionBy())).alias("before"))
    head = F.broadcast(heads.select(F.col("block").alias("b"), "top", "before"))
    own = F.struct("block", F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("before").alias("block"), F.lit(True).alias("ghost"))
    dealt = (
        placed.join(head, (F.col("block") == F.col("b")) & F.col("order").eqNullSafe(F.col("top")), "left")
        .select("order", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, ghost))).alias("w"))
        .select("w.block", "w.ghost", "order", "text")
    )
    line = Window.partitionBy("block").orderBy("ghost", F.desc("order"))
    neighbours = dealt.select(
        "block", "ghost", F.col("order.id").alias("id"), "text", F.row_number().over(line).alias("place"),
        F.coalesce(F.lead("text").over(line), F.lit("")).alias("next"), F.length("text").alias("n"))
    changed = F.concat(
        F.expr("left(text, n - cast(floor(n / 2) as int))"), F.expr("left(next, cast(floor(n / 2) as int))"))
    meta = neighbours.select(
        "block", "ghost", "id", "place", F.col("n").cast("long").alias("n_chars"),
        F.sha2(changed, 256).alias("edited_sha256"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
            F.struct(F.lit(1).alias("which"), changed.alias("body")),
        )).alias("v"),
    ).select("block", "ghost", "id", "place", "n_chars", "edited_sha256", "v.which", "v.body")
    keys = ["block", "ghost", "id", "place", "n_chars", "edited_sha256"]
    lanes = fingerprint_lanes(meta, [*keys, "which"], "body")
    packed = F.struct(*_NAMES)
    sides = lanes.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, packed)).alias("own"), F.max(F.when(F.col("which") == 1, packed)).alias("edited"))
    after = Window.partitionBy("block").orderBy("place")
    result = sides.withColumn("next", F.coalesce(F.lead("own").over(after), F.col("own"))).where(~F.col("ghost"))
    return result.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
