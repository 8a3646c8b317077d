"""Incremental scan of versioned texts for secrets.

The ledger is a folder of Parquet tables. ``versions`` maps every path, in all its
versions, to the digest of its content; ``scans`` remembers which rule versions have
seen which content; ``findings`` holds the spans per content and rule version. An
update scans only pairs of content and rule version that were never scanned, and
findings are joined back to every path that holds the content.

A null text is empty. Rows that repeat path and content in one update count once in
the ledger's content and once each in its versions; a later update that repeats them
adds none. A null path is a path like any other, and paths may have any type that
compares. Empty tables give empty ledgers. Other columns are not read. Only column functions are used.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from periodica.llm.common import text_of

#: Matches whose spans are gathered in one go.
STRETCH = 512
_SPANS = "array<struct<start:int,stop:int>>"
_FOUND = "array<struct<rule:string,spans:array<struct<start:int,stop:int>>>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules. A maximal run that must have n characters is
# asked for directly where that gives the same matches.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)


def spans_of(text: Column, rule: Rule) -> Column:
    """The spans of a rule in code points, ends exclusive.

    The pieces between matches and the matches alternate, so their lengths add up to
    the positions. They are added up in stretches of ``STRETCH`` matches, as each step
    copies the spans of its stretch: the work grows with the matches, not with their
    square. Each expression is evaluated once per text.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("key"),
    )
    none = F.array().cast(_SPANS)

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.array(F.struct(begin.alias("start"), end.alias("stop")))
        keep = F.coalesce(F.length(part["key"]) >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    def stretch(done: Column, first: Column, all_parts: Column) -> Column:
        start = F.struct(F.element_at(done, -1)["at"].alias("at"), none.alias("out"))
        return F.concat(done, F.array(F.aggregate(F.slice(all_parts, first, STRETCH), start, step)))

    def fold(all_parts: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(all_parts), F.lit(STRETCH))
        nothing = F.array(F.struct(F.lit(0).alias("at"), none.alias("out")))
        stretches = F.aggregate(firsts, nothing, lambda done, first: stretch(done, first, all_parts))
        return F.flatten(F.transform(stretches, lambda s: s["out"]))

    # As the one element of an array, the parts are a variable and not worked out again for each stretch.
    found = F.get(F.transform(F.array(parts), fold), F.lit(0))
    return F.when(text.rlike(rule.pattern), found).otherwise(none)


class Ledger:
    """Versions, scans and findings below one folder in the shared storage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _has(self, name: str) -> bool:
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/batch=*/_SUCCESS")
        return bool(pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern))

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._has(name):
            fields = StructType.fromDDL(schema)
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/batch=*")

    def _append(self, df: DataFrame, name: str, batch: str) -> None:
        """Each batch is a folder of its own, which Spark commits as a whole."""
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}/batch={batch}")

    def versions(self) -> DataFrame:
        """(path, digest); paths have the type that they were recorded with."""
        if self._has("versions"):
            return self.spark.read.parquet(f"{self.folder}/versions/batch=*").select("path", "digest")
        return self._read("versions", "path bigint, digest binary")

    def scans(self) -> DataFrame:
        return self._read("scans", "digest binary, rules array<string>")

    def findings(self) -> DataFrame:
        return self._read("findings", f"digest binary, found {_FOUND}")

    def unseen(self, versions: DataFrame, rules: Sequence[Rule], path: str, text: str) -> DataFrame:
        """(digest, text, todo): content that some rule version has not seen, once each."""
        blobs = (
            versions.select(text_of(F.col(text)).alias("text"))
            .withColumn("digest", F.unhex(F.sha2("text", 256)))
            .groupBy("digest").agg(F.any_value("text").alias("text"))
        )
        seen = self.scans().select("digest", F.explode("rules").alias("rule")).groupBy("digest").agg(
            F.collect_set("rule").alias("seen"))
        every = F.array(*(F.lit(r.name) for r in rules))
        todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "digest", "left").select("digest", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def update(
        self, versions: DataFrame, rules: Sequence[Rule] = BASE_RULES, path: str = "doc_id", text: str = "text"
    ) -> None:
        """Record the versions of ``versions`` and scan what is new.

        The text moves once, by its digest, and copies meet in a partial aggregate
        first. Versions that are on record are not recorded again, and scans are
        recorded after the findings, so a run that dies in between is repeated by the
        next one; equal findings of two runs count once.
        """
        batch = uuid.uuid4().hex
        digest = F.unhex(F.sha2(text_of(F.col(text)), 256))
        news = versions.select(F.col(path).alias("path"), digest.alias("digest"))
        if self._has("versions"):
            known = self.versions().select(F.struct("path", "digest").alias("known")).distinct()
            news = news.join(known, F.struct("path", "digest") == F.col("known"), "left_anti")
        self._append(news, "versions", batch)
        none = F.array().cast(_SPANS)
        found = F.array(*(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.when(F.array_contains("todo", r.name), spans_of(F.col("text"), r)).otherwise(none).alias("spans"),
            )
            for r in rules
        ))
        scanned = self.unseen(versions, rules, path, text).select("digest", "todo", found.alias("found"))
        # One pass writes both tables: content without a finding has an empty list.
        kept = F.filter("found", lambda f: F.size(f["spans"]) > 0)
        self._append(scanned.select("digest", kept.alias("found"), "todo"), "findings", batch)
        done = self.spark.read.parquet(f"{self.folder}/findings/batch={batch}")
        self._append(done.select("digest", F.col("todo").alias("rules")), "scans", batch)

    def by_content(self, rules: Sequence[Rule] = BASE_RULES) -> DataFrame:
        """(digest, rule, start, stop) of the given rule versions, once each."""
        return (
            self.findings().where(F.size("found") > 0)
            .select("digest", F.explode("found").alias("f"))
            .where(F.col("f.rule").isin([r.name for r in rules]))
            .select("digest", "f.rule", F.explode("f.spans").alias("s"))
            .select("digest", "rule", "s.start", "s.stop").distinct()
        )

    def by_path(self, rules: Sequence[Rule] = BASE_RULES) -> DataFrame:
        """One row per version of a path with its sorted findings: ``path``, ``digest``, ``spans``.

        Content is folded to one row before it meets the paths, so content that a
        third of all paths share is a join of many rows with one, which adaptive
        execution splits or broadcasts.
        """
        order = F.array(*(F.lit(r.name) for r in rules))
        per = self.by_content(rules).groupBy("digest").agg(
            F.array_sort(F.collect_list(F.struct("start", F.array_position(order, F.col("rule")).alias("place"), "stop")))
            .alias("spans"))
        none = F.array().cast("array<struct<start:int,place:bigint,stop:int>>")
        return self.versions().join(per, "digest", "left").select(
            "path", "digest", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column, rules: Sequence[Rule] = BASE_RULES) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["place"].cast("int")), s["start"], s["stop"])),
        ",",
    )
