"""Canonical facts, yearly core financials in reporting currency and dollars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions.money import to_usd
from periodica.operators.aggregates import row_currency
from periodica.operators.joins import asof_join, wildcard_join

YEAR_KEY = ["company_id", "fiscal_year", "period_end"]


def tag_mapping(facts: DataFrame) -> DataFrame:
    """The packaged tag mapping as a relation of 118 rows."""
    return constants.table(facts.sparkSession, "tag_mapping")


def normalized_facts(facts: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Facts whose tag is known, with canonical field and combination rule."""
    return wildcard_join(facts, tag_mapping(facts) if mapping is None else mapping)


def core_rows(facts: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Yearly facts that core financials are made from, with canonical field and combination rule."""
    fields = ("revenue", *constants.CORE_FIELDS.values())
    yearly = facts.where("fiscal_period = 'FY'")
    if mapping is None:
        # The packaged tags are known, so the scan can skip all other facts.
        yearly = yearly.where(F.col("concept").isin(*constants.tags_for(fields)))
        mapping = tag_mapping(facts)
    return wildcard_join(yearly, mapping.where(F.col("field").isin(*fields)))


def _best(field: str) -> Column:
    return F.max(F.when(F.col("field") == field, F.col("value")))


def core_amounts(
    facts: DataFrame, mapping: DataFrame | None = None, component_versions: str = "latest"
) -> DataFrame:
    """One row per company, fiscal year and period end with the eight metrics.

    All metrics come from one conditional aggregate over one scan. Revenue is the
    greatest reported total, else the sum of its components. The sum takes the
    latest filing of each component; ``component_versions="all"`` adds up every
    filing that repeats it. The row currency is the greatest money unit of total
    revenue, else of total assets.
    """
    rows = core_rows(facts, mapping)
    is_total = (F.col("field") == "revenue") & F.col("combine").isNull()
    is_part = (F.col("field") == "revenue") & (F.col("combine") == "sum")
    others = {name: _best(field) for name, field in constants.CORE_FIELDS.items()}
    if component_versions == "latest":
        # Repeated filings of one component collapse first. What tells components apart is
        # blanked in all other rows, so those fold to one per field and unit before the shuffle.
        apart = ["concept", "namespace", "period_start"]
        rows = rows.withColumns({c: F.when(is_part, F.col(c)) for c in apart})
        fact = [*YEAR_KEY, "field", "combine", *apart, "unit"]
        newest = F.max_by("value", F.struct("filing_date", "source_id", "value"))
        rows = rows.groupBy(*fact).agg(
            F.when(is_part, newest).otherwise(F.max("value")).alias("value")
        )
    elif component_versions != "all":
        raise ValueError(f"component_versions must be 'latest' or 'all', not {component_versions!r}")
    revenue = F.coalesce(
        F.max(F.when(is_total, F.col("value"))), F.sum(F.when(is_part, F.col("value")))
    )
    currency = row_currency(
        F.when(is_total, F.col("unit")), F.when(F.col("field") == "total_assets", F.col("unit"))
    )
    return rows.groupBy(*YEAR_KEY).agg(
        revenue.alias("revenue"), *[best.alias(name) for name, best in others.items()], currency.alias("currency")
    )


def add_usd(amounts: DataFrame, fx: DataFrame, metrics: Sequence[str] = constants.CORE_METRICS) -> DataFrame:
    """Dollar columns next to the metrics, by the latest rate on or before period end.

    The rates of the packaged currencies are one row each, bounded by the calendar (some
    24 bytes a day), and go to the rows: amounts are not shuffled again, those in
    dollars, which have no rate, included.
    """
    codes = [c for c in constants.currency_codes() if c != "USD"]
    rated = asof_join(
        amounts, fx.select("currency", "rate_date", "usd_per_unit").where(F.col("currency").isin(*codes)),
        ["currency"], "period_end", "rate_date", "usd_per_unit", bounded=True,
    )
    others = [c for c in amounts.columns if c not in metrics and c != "currency"]
    pairs = [
        x for m in metrics
        for x in (F.col(m), to_usd(F.col(m), F.col("currency"), F.col("usd_per_unit")).alias(f"{m}_usd"))
    ]
    return rated.select(*others, *pairs, "currency")


def core_financials(
    facts: DataFrame, fx: DataFrame, mapping: DataFrame | None = None, component_versions: str = "latest"
) -> DataFrame:
    """Yearly core financials with dollar amounts.

    Facts are aggregated before conversion, so rates are looked up once per
    company-year and not once per fact.
    """
    return add_usd(core_amounts(facts, mapping, component_versions), fx)


def balance_effective(core: DataFrame) -> DataFrame:
    """Balance with liabilities derived from assets and equity where not reported."""
    gap = F.col("total_assets") - F.col("stockholders_equity")
    return core.select(
        *YEAR_KEY,
        "total_assets",
        F.coalesce("total_liabilities", gap).alias("liabilities_effective"),
        (F.col("total_liabilities").isNull() & gap.isNotNull()).alias("liabilities_derived"),
        "stockholders_equity",
        "cash",
    )
