"""Removal of lines that many sites share.

Every line hash gets a HyperLogLog sketch of the sites that carry it; sketches merge
by aggregation, so a line on all pages of the web costs one sketch per task. Lines
whose estimate is clearly below or above ``min_sites`` are decided by it, lines near
the threshold get an exact distinct count. A line that reaches the threshold is
boilerplate and goes from every document but the one with the smallest id, so no text
vanishes from the corpus.

Lines are compared without spaces, tabs and carriage returns at their ends; blank
lines are never boilerplate. A null site counts for no site, a null text has no
lines and stays null, rows that repeat an id are treated alike (all rows with the
smallest id keep the line; if all ids are null, those rows do). Empty tables give
empty results. Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import staged

#: log2 of the registers: a standard error of about 1.6 %.
LG_K = 12
#: Estimates this close to the threshold are counted exactly: over six standard errors.
BAND = 0.1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """96 bits of two independent hashes of the trimmed line; null for a blank line."""
    trimmed = F.btrim(line, F.lit(" \t\r"))
    return F.when(trimmed != "", F.struct(F.xxhash64(trimmed).alias("a"), F.hash(trimmed).alias("b")))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """(text_key, doc_id, site, line): one row per distinct line hash of a document."""
    distinct = F.array_distinct(F.filter(F.transform(_lines(F.col(text)), _key), lambda k: k.isNotNull()))
    return docs.select(
        _text_key(F.col(text)).alias("text_key"), F.col(doc_id).alias("doc_id"),
        F.col(site).cast("string").alias("site"), F.explode(distinct).alias("line"),
    )


def shared_lines(keys: DataFrame, min_sites: int) -> DataFrame:
    """(line, first_id) of the lines on ``min_sites`` sites or more."""
    spread = keys.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("about"), F.min("doc_id").alias("first_id")
    ).where(F.col("about") >= min_sites * (1 - BAND) - 1)
    spread = staged(spread, "line-spread")
    near = F.col("about") <= min_sites * (1 + BAND) + 1
    counted = (
        keys.join(spread.where(near), "line").groupBy("line", "first_id")
        .agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    )
    return spread.where(~near).select("line", "first_id").unionByName(counted.select("line", "first_id"))


def remove_shared_lines(
    docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """``doc_id``, the cleaned ``text``, ``n_lines`` and ``n_removed`` of every row, and its other columns as ``row``.

    ``row`` is a struct of all columns of ``docs``, so no name can clash. Shared
    lines are gathered per distinct text, of which they are a subset, and texts
    meet them once; copies of one text are a join of many rows with one.
    """
    keys = staged(line_keys(docs, doc_id, text, site), "line-keys")
    shared = staged(shared_lines(keys, min_sites), "shared-lines")
    per_text = staged(
        keys.select("text_key", "line").distinct().join(shared, "line")
        .groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("line", F.struct("first_id")))).alias("shared"))
        .withColumnRenamed("text_key", "shared_key"),
        "shared-per-text",
    )
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("text_key", _text_key(F.col("row")[text]))
    joined = rows.join(per_text, F.col("text_key") == F.col("shared_key"), "left")
    here = F.col("row")[doc_id]

    def stays(line: Column) -> Column:
        owner = F.try_element_at("shared", _key(line))
        return owner.isNull() | owner["first_id"].eqNullSafe(here)

    lines = _lines(F.col("row")[text])
    kept = F.when(F.col("shared").isNull(), lines).otherwise(F.filter(lines, stays))
    counts = joined.select("row", kept.alias("kept"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"))
    size = F.when(F.col("kept").isNull(), 0).otherwise(F.size("kept"))
    return counts.select(
        here.alias("doc_id"), F.array_join("kept", "\n").alias("text"),
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - size).cast("long").alias("n_removed"),
        "row",
    )
