"""Derived tables brought up to date with what a load has changed.

A version of the derived table notes the folders that it was made from. Folders are
never changed, so those that came or went since hold all that can differ: their keys
are made anew from the current rows, and whatever has another key stays. Partitions
without such keys keep their files, and neither their facts nor their results are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.operators.joins import absent_keys, null_safe_key
from periodica.operators.writes import ATTEMPTS, Overlap, ParquetTable, partitions_of, within_partitions
from periodica.plans.core import YEAR_KEY, core_financials, core_rows
from periodica.sources.tables import Catalog


def _origin(how: str, source: ParquetTable, lookup: ParquetTable) -> tuple[list[str], list[str], list[str]]:
    """Folders of both tables, and the lines that note them."""
    of_source, of_lookup = source.partitions(), lookup.partitions()
    lines = [f"how {how}", *(f"source {f}" for f in of_source), *(f"lookup {f}" for f in of_lookup)]
    return of_source, of_lookup, lines


def _differing(table: ParquetTable, kind: str, before: Sequence[str], now: Sequence[str]) -> list[str]:
    """Folders that came or went."""
    known = {line[len(kind) + 1 :] for line in before if line.startswith(f"{kind} ")}
    return sorted(known ^ set(now))


def refresh_changed(
    derived: ParquetTable,
    source: ParquetTable,
    lookup: ParquetTable,
    keys: Sequence[str],
    build: Callable[[DataFrame, DataFrame], DataFrame],
    relevant: Callable[[DataFrame], DataFrame],
    concerned: Callable[[DataFrame, DataFrame], DataFrame],
    how: str = "",
) -> int:
    """Bring a derived table up to date; returns the rows written.

    ``build`` makes it from rows of ``source`` and ``lookup``, each key from the source
    rows of that key alone. ``relevant`` picks those source rows that matter to it, and
    ``concerned`` those derived rows that the given lookup rows can have a bearing on.
    The result equals a full build. That is what happens the first time, when ``how``
    (a name for the way of building) is another one, and when folders that the last
    version was made from are no longer there. A derived table that somebody else
    changed in the meantime is read again; if a build fails, it stays as it was.
    """
    if not derived.partition_by or not set(derived.partition_by) <= set(keys):
        raise ValueError(f"{derived.path} must be partitioned by some of {list(keys)}")
    for attempt in range(ATTEMPTS):
        state = derived.state()
        of_source, of_lookup, lines = _origin(how, source, lookup)
        before = derived.origin(state.version) if state.version else None
        if before is not None and sorted(before) == sorted(lines):
            return 0
        try:
            if before is not None and before[0] == lines[0]:
                moved = _differing(source, "source", before, of_source), _differing(lookup, "lookup", before, of_lookup)
                if source.folders_exist(moved[0]) and lookup.folders_exist(moved[1]):
                    return _refresh_some(
                        derived, state, source, lookup, of_source, of_lookup, moved, keys, build, relevant, concerned, lines)
            rows, rates = source.rows_of(of_source), lookup.rows_of(of_lookup)
            return derived.replace(build(rows, rates), state, origin=lines)
        except Overlap:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def _refresh_some(
    derived, state, source, lookup, of_source, of_lookup, moved, keys, build, relevant, concerned, lines
) -> int:
    rows, rates, stored = source.rows_of(of_source), lookup.rows_of(of_lookup), derived.read(state)
    changed = relevant(source.rows_of(moved[0])).select(*keys)
    if moved[1]:
        changed = changed.unionByName(concerned(stored, lookup.rows_of(moved[1])).select(*keys))
    changed = changed.distinct()
    # As many as the table has, or will have, partitions.
    touched = partitions_of(changed, derived.partition_by)
    here = within_partitions(derived.partition_by, touched)
    known = changed.select(null_safe_key(keys).alias("_key"))
    # Rows of a key are fewer once they are made, so those of other keys are left out then and not before.
    made = build(rows.where(here), rates).withColumn("_key", null_safe_key(keys))
    anew = made.join(known, "_key", "left_semi").drop("_key")
    kept = absent_keys(stored.where(here), changed, keys)
    return derived.replace_partitions(kept.unionByName(anew), touched, state, lines)


def rated_since(core: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows whose rate can be another one because of these rates: of their currencies, from their first day on."""
    firsts = rates.groupBy("currency").agg(F.min(F.col("rate_date").cast("date")).alias("_since"))
    return core.join(firsts, "currency").where(F.col("period_end") >= F.col("_since")).drop("_since")


def core_table(facts: ParquetTable, rates: ParquetTable, path: str) -> ParquetTable:
    """The place of stored core financials, by fiscal year as the facts are."""
    columns = core_financials(facts.rows_of([]), rates.rows_of([])).schema
    return ParquetTable(facts.spark, path, columns, ["fiscal_year"], ["company_id"])


def refresh_core_table(
    core: ParquetTable, facts: ParquetTable, rates: ParquetTable, component_versions: str = "latest"
) -> int:
    """Bring stored core financials up to date with facts and rates; returns the rows written."""
    return refresh_changed(
        core, facts, rates, YEAR_KEY,
        build=lambda rows, fx: core_financials(rows, fx, component_versions=component_versions),
        relevant=core_rows, concerned=rated_since, how=f"component_versions={component_versions}",
    )


def refresh_core(catalog: Catalog, component_versions: str = "latest") -> int:
    """``refresh_core_table`` for a catalog, whose table ``core_financials`` is next to the facts."""
    facts, rates = catalog.store("financial_facts"), catalog.store("fx_rates")
    return refresh_core_table(core_table(facts, rates, f"{catalog.root}/core_financials"), facts, rates, component_versions)
