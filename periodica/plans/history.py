"""What was known, and who was a member, on a given day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodica import constants
from periodica.operators.joins import interval_join, resolve_tickers
from periodica.operators.windows import VERSION_ORDER, latest_known
from periodica.operators.writes import ParquetTable, change, replace_rows

FACT_KEY = ("company_id", "fiscal_year", "concept")


def version_intervals(
    facts: DataFrame, key: Sequence[str] = FACT_KEY, columns: Sequence[str] | None = None
) -> DataFrame:
    """Each fact version with the days ``[known_from, known_to)`` on which it is the one to read.

    A version can be read from the later of filing date and period end. Among
    those readable, the latest filing wins, so an older filing whose period ends
    later never takes over. Versions that never win are absent. ``columns`` names what
    is wanted besides the key; only those and the order are read and sorted.
    """
    key = list(key)
    rest = [c for c in (facts.columns if columns is None else columns) if c not in key]
    # NULL sorts first in a struct, which makes it lose against any date. Each column is in it once.
    version = F.struct(*VERSION_ORDER, *[c for c in rest if c not in VERSION_ORDER])
    dated = facts.where("filing_date IS NOT NULL AND period_end IS NOT NULL").withColumn(
        "known_from", F.greatest("filing_date", "period_end")
    )
    # At most one row per key and day from here on, however many copies there are.
    daily = dated.groupBy(*key, "known_from").agg(F.max(version).alias("_best"))
    timeline = Window.partitionBy(*key).orderBy("known_from")
    running = F.max("_best").over(timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    winners = (
        daily.withColumn("_now", running)
        .withColumn("_was", F.lag("_now").over(timeline))
        .where(~F.col("_now").eqNullSafe(F.col("_was")))
        .withColumn("known_to", F.lead("known_from").over(timeline))
    )
    return winners.select(*key, *[F.col(f"_now.{c}").alias(c) for c in rest], "known_from", "known_to")


def _calendar(dates: DataFrame) -> DataFrame:
    """Distinct days of a relation.

    They number at most 36,525 per century whatever the input, a few hundred
    kilobytes, so they are safe to broadcast and the other side stays in place.
    """
    return F.broadcast(dates.select(F.col("as_of").cast("date")).distinct())


def facts_as_of(
    facts: DataFrame, as_of, key: Sequence[str] = FACT_KEY, columns: Sequence[str] | None = None
) -> DataFrame:
    """Facts as they were public on one day, or on every day of a relation.

    With a DataFrame of days (column ``as_of``) the versions are turned into
    validity intervals once, and each day only meets the versions valid then.
    ``columns`` names what is wanted besides the key.
    """
    if isinstance(as_of, DataFrame):
        versions = version_intervals(facts, key, columns)
        return interval_join(_calendar(as_of), versions, "as_of", "known_from", "known_to").drop("known_from", "known_to")
    found = latest_known(facts, as_of, key)
    if columns is not None:
        found = found.select(*key, *[c for c in columns if c not in key])
    return found.withColumn("as_of", F.lit(as_of).cast("date"))


def members_at(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Members on each day of a relation (column ``as_of``), one row per day and ticker."""
    days = _calendar(dates)
    kept = [c for c in intervals.columns if c not in ("ticker", "start_date", "end_date")]
    found = interval_join(days, intervals, "as_of").groupBy("as_of", "ticker")
    # Overlapping intervals of one ticker count once.
    return found.agg(*[F.max(c).alias(c) for c in kept]) if kept else found.agg(F.lit(1)).select("as_of", "ticker")


def membership_sanity(
    intervals: DataFrame, bounds: tuple[int, int] = constants.INDEX_MEMBERS, extra_years: Sequence[int] = ()
) -> DataFrame:
    """Member count at the end of every year in which an interval starts."""
    years = intervals.select(F.year("start_date").alias("y")).distinct()
    if extra_years:
        years = years.union(intervals.sparkSession.createDataFrame([(y,) for y in extra_years], "y int")).distinct()
    days = _calendar(years.select(F.make_date("y", F.lit(12), F.lit(31)).alias("as_of")))
    found = interval_join(days, intervals.select("ticker", "start_date", "end_date"), "as_of")
    counted = found.groupBy("as_of").agg(F.count_distinct("ticker").alias("members"))
    members = F.coalesce("members", F.lit(0))
    return days.join(counted, "as_of", "left").select(
        "as_of", members.alias("members"), members.between(*bounds).alias("plausible")
    )


def membership_rows(parsed: DataFrame, listings: DataFrame, source: str, loaded_at) -> DataFrame:
    """Parsed intervals with their company, as stored."""
    tickers = parsed.select("ticker").distinct()
    return parsed.join(resolve_tickers(tickers, listings), "ticker", "left").select(
        "ticker", "start_date", "end_date", "company_id",
        F.lit(source).alias("source"), F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
    )


def membership_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct("ticker").alias("tickers"),
        F.count("company_id").alias("resolved"),
        F.count_if(F.col("company_id").isNull()).alias("unresolved"),
        F.min("start_date").alias("first_date"),
        F.max(F.coalesce("end_date", "start_date")).alias("last_date"),
    )


def load_membership(
    table: ParquetTable, parsed: DataFrame, listings: DataFrame, source: str, loaded_at, replace: bool = True
) -> DataFrame:
    """Replace one source's intervals and return the load statistics.

    Intervals of other sources with the same ticker and start are overwritten.
    """
    from periodica.operators.joins import absent_keys

    rows = membership_rows(parsed, listings, source, loaded_at)

    def loaded(stored: DataFrame) -> DataFrame:
        kept = replace_rows(stored, F.col("source") == source, stored.limit(0)) if replace else stored
        return absent_keys(kept, rows, ["ticker", "start_date"]).unionByName(rows)

    change(table, loaded)
    return membership_stats(table.read().where(F.col("source") == source))


def member_runs(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """Per ticker and company, the runs of days of a relation on which the ticker stands for the company.

    A run is a half-open interval from its first day to the one after its last. A ticker
    that stands for two companies on a day counts for one, as in ``members_at``.
    """
    days = dates.select(F.col("as_of").cast("date")).where("as_of IS NOT NULL").distinct()
    # The calendar bounds the days, so they can be numbered in one task and broadcast.
    numbered = F.broadcast(days.withColumn("_n", F.row_number().over(Window.orderBy("as_of"))))
    members = members_at(intervals.select("ticker", "company_id", "start_date", "end_date"), dates).where("ticker IS NOT NULL")
    line = Window.partitionBy("ticker", "company_id").orderBy("as_of")
    runs = members.join(numbered, "as_of").withColumn("_run", F.col("_n") - F.row_number().over(line))
    return runs.groupBy("ticker", "company_id", "_run").agg(
        F.min("as_of").alias("start_date"), F.date_add(F.max("as_of"), 1).alias("end_date")
    ).drop("_run")


def pit_universe(
    intervals: DataFrame, facts: DataFrame, dates: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """For each day: the members then and their facts as public then.

    Per company, the days on which a fact version is the one to read are cut with the
    runs of days of membership; only what is left of both is expanded to days, and that
    is the result, which is not shuffled again. ``columns`` names the wanted facts columns.
    """
    resolved = intervals.where("company_id IS NOT NULL")
    spans = member_runs(resolved, dates)
    concerned = facts.join(resolved.select("company_id"), "company_id", "left_semi")
    versions = version_intervals(concerned, columns=columns)
    both = spans.join(versions, "company_id").where(
        (F.col("known_from") < F.col("end_date"))
        & (F.col("known_to").isNull() | (F.col("start_date") < F.col("known_to")))
    )
    # Least and greatest skip NULL, which is an open end.
    cut = both.withColumns(
        {"known_from": F.greatest("known_from", "start_date"), "known_to": F.least("known_to", "end_date")}
    ).drop("start_date", "end_date")
    return interval_join(_calendar(dates), cut, "as_of", "known_from", "known_to").drop("known_from", "known_to")
