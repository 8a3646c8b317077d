"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Names that the operators use inside.
CLASHING = ("row", "line", "block", "grp", "score", "text_key", "n_words", "node", "digest", "shared", "before", "votes")

SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
     StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(c, StringType()) for c in CLASHING]
)


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("aeioulnrstdm") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def texts() -> list[str | None]:
    """About sixty texts: plain, copies, near copies, odd characters, empty, null, very long."""
    rng = random.Random(7)
    out: list[str | None] = [None, "", " ", "\n\n", "a", "One two", "A\tB\rC  d", "Ünïcode İ ΑΣ. 漢字 \U0001f600 x", None, "."]
    for _ in range(20):
        lines = [" ".join(words(rng, rng.randint(1, 14))).capitalize() + "." for _ in range(rng.randint(1, 5))]
        out.append("\n".join(lines))
    base = words(rng, 120)
    for k in range(12):
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(99))
        out.append(" ".join(copy))
    out += [" ".join(base)] * 5 + [out[15], out[15]]
    out.append(" ".join(words(rng, 6000)))
    return out


def documents(spark, values=None, repeat=True):
    """The texts as documents with clashing columns; some ids repeat and one is null."""
    values = texts() if values is None else values
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or ""), *CLASHING) for i, t in enumerate(values)]
    if repeat:
        rows += [rows[12], rows[13], (13, "another text under a known id", "en", "s1", 1, *CLASHING)]
        rows.append((None, "a text without an id", "en", "s1", 1, *CLASHING))
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_words(text: str | None) -> list[bytes]:
    """Words by ASCII white space, A-Z lower-cased, letter by letter."""
    out, now = [], bytearray()
    for b in (text or "").encode():
        if b == 32 or 9 <= b <= 13:
            if now:
                out.append(bytes(now))
            now = bytearray()
        else:
            now.append(b + 32 if 65 <= b <= 90 else b)
    return [*out, bytes(now)] if now else out
