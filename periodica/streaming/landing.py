"""Landing of new files, each once, and the bookkeeping around it.

The streaming checkpoint remembers which files were taken. A batch can be handed
over twice after a failure. A sink that knows the name of its feed stores the batch's
number with its rows, so a repeated batch is known before any row is read; any other
inserts only absent keys. No operator state grows with the history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from periodica.operators.joins import absent_keys
from periodica.operators.writes import (
    ParquetTable, WriteStats, change_partitions, first_per_key, insert_new, refresh_snapshot,
)
from periodica.session import scratch_dir

Sink = Callable[[DataFrame, int], None]


def land_incremental(
    spark: SparkSession,
    source: str,
    sink: Sink,
    name: str,
    fmt: str = "text",
    schema: StructType | str | None = None,
    checkpoint: str | None = None,
    max_files: int | None = None,
    **options: str,
) -> None:
    """Hand every file that has not been seen yet to the sink, then stop.

    The source is a folder, a single file or a pattern. Interrupted runs go on where
    they were. The checkpoint defaults to a folder below the shared one the session
    names.
    """
    if not set("*?[{") & set(source):
        # As a pattern, a path may be a file as well as a folder.
        parent, _, last = source.rstrip("/").rpartition("/")
        source = f"{parent}/{{{last}}}"
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "text":
        reader = reader.option("wholetext", True)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(source).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint or f"{scratch_dir(spark)}/landing/{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def insert_sink(
    table: ParquetTable,
    keys: Sequence[str],
    parse: Callable[[DataFrame], DataFrame],
    prune: Sequence[str] = (),
    record: Callable[[int, WriteStats], None] | None = None,
    feed: str | None = None,
) -> Sink:
    """A sink that parses a batch and inserts what is new.

    ``prune`` names partition columns that follow from the key, and only those.
    ``feed`` names the stream, one for each checkpoint: a batch of it that was stored
    is not parsed again and reports nothing.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        tag = f"{feed}-{batch_id}" if feed else None
        target = table.on(batch.sparkSession)
        if tag and target.stored(tag):
            return
        stats = insert_new(target, parse(batch), keys, prune=prune, tag=tag)
        if record:
            record(batch_id, stats)

    return sink


def changed_documents(scan: DataFrame, registry: DataFrame) -> DataFrame:
    """Scanned files that are new or whose content differs from the registered one."""
    return absent_keys(scan, registry, ["source_identifier", "checksum"])


def registry_with(registry: DataFrame, scan: DataFrame) -> DataFrame:
    """Registry extended by changed contents; earlier versions of a file stay."""
    return registry.unionByName(changed_documents(scan, registry), allowMissingColumns=True)


def dedup_versions(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact repetitions removed; rows that differ in the key are versions and stay.

    Late rows are welcome at any time, so there is no watermark and no state.
    """
    return first_per_key(batch, keys).select(*batch.columns)


FACT_KEY = ["company_id", "concept", "period_start", "period_end", "filing_id", "source_id"]


def newly_linked(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Unlinked facts whose filing is stored by now, with its id.

    The accession number is the first part of the source id.
    """
    stored = filings.select(
        F.col("company_id").alias("_company"), F.col("accession_number").alias("_number"), F.col("id").alias("_found")
    )
    number = F.split_part("source_id", F.lit("|"), F.lit(1))
    return (
        facts.where("filing_id IS NULL").withColumn("_accession", number)
        .join(stored, (F.col("company_id") == F.col("_company")) & (F.col("_accession") == F.col("_number")))
        .select(*[F.col("_found").alias(c) if c == "filing_id" else F.col(c) for c in facts.columns])
    )


def relink_filings(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts whose filing was stored after them, now linked to it.

    Where linking would repeat a linked fact, the linked one stays; of several newly
    linked ones the first by value. The facts are shuffled once, by company and number,
    for the join: facts of one key share both, so they are told apart where they lie.
    """
    stored = filings.select(
        F.col("company_id").alias("_company"), F.col("accession_number").alias("_stored_number"),
        F.col("id").alias("_found"), F.lit(True).alias("_hit"),
    )
    numbered = facts.withColumn("_number", F.split_part("source_id", F.lit("|"), F.lit(1)))
    due = (F.col("company_id") == F.col("_company")) & (F.col("_number") == F.col("_stored_number")) & F.col("filing_id").isNull()
    tried = numbered.join(stored, due, "left").withColumn("filing_id", F.coalesce("filing_id", "_found"))
    own = [c for c in FACT_KEY if c != "company_id"]
    line = Window.partitionBy("company_id", "_number", *own).orderBy(
        F.col("_hit").isNotNull(), "value", *[c for c in ("id",) if c in facts.columns]
    )
    ranked = tried.withColumn("_rank", F.row_number().over(line))
    return ranked.where(F.col("_hit").isNull() | (F.col("_rank") == 1)).select(*facts.columns)


def relink_table(facts: ParquetTable, filings: DataFrame) -> int:
    """Link stored facts to filings that came later; years without such facts keep their files.

    Facts of one key end on one day. Where years are those of the period ends, they are
    therefore rewritten in rounds. Returns the rows rewritten.
    """
    by_end = F.year("period_end").eqNullSafe(F.col("fiscal_year")) if facts.partition_by == ["fiscal_year"] else None
    return change_partitions(
        facts, lambda rows: newly_linked(rows, filings), lambda rows: relink_filings(rows, filings), by_end)


def pending_documents(raw_docs: DataFrame, provider=None) -> DataFrame:
    """Registered documents that were not processed yet, oldest first."""
    found = raw_docs.where("NOT is_processed")
    if provider is not None:
        found = found.where(F.col("provider_id") == provider)
    return found.orderBy("retrieved_at", "source_identifier")


def refresh_after(job: Callable[[], object], snapshot: ParquetTable, build: Callable[[], DataFrame]) -> object:
    """Run a load, then store the derived table anew; a failed load leaves it as it was."""
    result = job()
    refresh_snapshot(snapshot, build())
    return result
