"""Set-based lookups: each takes a relation of keys and answers all of them in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.operators.filters import instant_facts
from periodica.operators.windows import latest_by

Tables = Mapping[str, DataFrame]


def _only(df: DataFrame, keys_df: DataFrame | None) -> DataFrame:
    return df if keys_df is None else df.join(keys_df, keys_df.columns, "left_semi")


def facts_with_provenance(t: Tables) -> DataFrame:
    """Facts with provider, filing and, where stored, the raw document behind them."""
    filings = t["filings"].select(
        F.col("id").alias("filing_id"), F.col("form").alias("filing_form"), "accession_number",
        F.col("filing_date").alias("filed_on"), "raw_document_id",
    )
    providers = t["data_providers"].select(
        F.col("id").alias("provider_id"), F.col("name").alias("provider_name"), F.col("type").alias("provider_type")
    )
    documents = t["raw_documents"].select(F.col("id").alias("raw_document_id"), F.col("storage_path").alias("raw_file"))
    facts = t["financial_facts"].select(
        "company_id", "concept", "value", "unit", "period_start", "period_end",
        "fiscal_year", "fiscal_period", "filing_id", "provider_id", "source_id",
    )
    # Documents belong to filings, which are far fewer than facts.
    sourced = filings.join(documents, "raw_document_id", "left").drop("raw_document_id")
    return facts.join(sourced, "filing_id").join(providers, "provider_id").drop("provider_id")


def facts_for(
    t: Tables, keys_df: DataFrame, latest: bool = False, instant: bool = False
) -> DataFrame:
    """Facts of the given companies, or of (company, concept) pairs.

    ``latest`` keeps the last filed row per company and concept, ``instant`` the
    balance-sheet values.
    """
    facts = _only(t["financial_facts"], keys_df)
    if instant:
        facts = instant_facts(facts)
    if latest:
        facts = latest_by(facts, ["company_id", "concept"], ["filing_date", "period_end", "source_id", "value"])
    names = t["companies"].select(F.col("id").alias("company_id"), "legal_name")
    return facts.join(names, "company_id")


# Lookup kind -> table and the columns a key relation may use.
_KINDS = {
    "identifier": ("company_identifiers", ("identifier_value", "identifier_type", "provider_id", "company_id")),
    "listing": ("company_listings", ("ticker", "company_id", "exchange_id")),
    "filing": ("filings", ("accession_number", "provider_id", "company_id", "form")),
    "exchange": ("exchanges", ("code", "id")),
    "provider": ("data_providers", ("name", "id")),
    "company": ("companies", ("id", "legal_name")),
}


def lookup(t: Tables, kind: str, keys_df: DataFrame) -> DataFrame:
    """Rows of an entity table whose columns match the key relation."""
    table, allowed = _KINDS[kind]
    unknown = set(keys_df.columns) - set(allowed)
    if unknown:
        raise ValueError(f"{kind} cannot be looked up by {sorted(unknown)}")
    return _only(t[table], keys_df)


def recent_filings(t: Tables, per_company: int, keys_df: DataFrame | None = None) -> DataFrame:
    """The last filings of each company."""
    from pyspark.sql import Window

    rank = F.row_number().over(
        Window.partitionBy("company_id").orderBy(F.col("filing_date").desc(), F.col("accession_number").desc())
    )
    return _only(t["filings"], keys_df).withColumn("_n", rank).where(F.col("_n") <= per_company).drop("_n")


def _dated(
    rows: DataFrame, day: str, listings: DataFrame | None, since, until
) -> DataFrame:
    found = _only(rows, listings)
    if since is not None:
        found = found.where(F.col(day) >= F.lit(since).cast("date"))
    if until is not None:
        found = found.where(F.col(day) <= F.lit(until).cast("date"))
    return found


def prices(t: Tables, listings: DataFrame | None = None, since=None, until=None, latest: bool = False) -> DataFrame:
    """Daily bars by listing and day range, or the newest bar of each listing."""
    found = _dated(t["prices"], "price_date", listings, since, until)
    return latest_by(found, ["listing_id"], ["price_date", "provider_id"]) if latest else found


def dividends(t: Tables, listings: DataFrame | None = None, since=None, until=None) -> DataFrame:
    return _dated(t["dividends"], "ex_date", listings, since, until)


def splits(t: Tables, listings: DataFrame | None = None, since=None, until=None) -> DataFrame:
    return _dated(t["splits"], "execution_date", listings, since, until)


def company_page(t: Tables, limit: int, offset: int = 0, order: Sequence[str] = ("legal_name", "id")) -> DataFrame:
    """Active companies by name, one page."""
    from periodica.operators.paging import page

    return page(t["companies"].where("is_active"), order, limit, offset)
