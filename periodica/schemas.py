"""Declared schemas of the relational tables and of the landed documents."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

TABLES = {
    "data_providers": "id string, name string, type string, base_url string, rate_limit decimal(10,2), is_active boolean",
    "exchanges": "id string, code string, name string, country string, timezone string, currency string, is_active boolean",
    "companies": (
        "id string, legal_name string, country string, sector string, industry string, currency string, "
        "website string, is_active boolean, delisted_at date, last_synced_at timestamp, updated_at timestamp"
    ),
    "company_identifiers": (
        "id string, company_id string, identifier_type string, identifier_value string, provider_id string, "
        "is_primary boolean, valid_from date, valid_to date"
    ),
    "company_listings": (
        "id string, company_id string, exchange_id string, ticker string, share_class string, "
        "listing_date date, delisting_date date, is_primary boolean, is_active boolean"
    ),
    "filings": (
        "id string, company_id string, provider_id string, form string, accession_number string, filing_date date, "
        "period_start date, period_end date, fiscal_year int, fiscal_period string, filing_url string, "
        "raw_document_id string, is_amended boolean, amended_by_filing_id string, created_at timestamp"
    ),
    "financial_facts": (
        "id string, company_id string, filing_id string, provider_id string, namespace string, concept string, "
        "value decimal(30,10), unit string, period_start date, period_end date, fiscal_year int, "
        "fiscal_period string, form string, source_id string, filing_date date, frame string, currency string, "
        "created_at timestamp"
    ),
    "prices": (
        "id string, listing_id string, provider_id string, price_date date, open decimal(20,6), high decimal(20,6), "
        "low decimal(20,6), close decimal(20,6), adjusted_close decimal(20,6), volume bigint, currency string, "
        "source_id string, price_year int"
    ),
    "dividends": (
        "id string, listing_id string, provider_id string, ex_date date, record_date date, payment_date date, "
        "amount decimal(20,10), currency string, source_id string"
    ),
    "splits": (
        "id string, listing_id string, provider_id string, execution_date date, numerator int, denominator int, "
        "source_id string"
    ),
    "raw_documents": (
        "id string, provider_id string, source_identifier string, storage_path string, checksum string, "
        "content_type string, retrieved_at timestamp, metadata map<string,string>, is_processed boolean"
    ),
    "import_runs": (
        "id string, provider_id string, pipeline string, status string, company_id string, records_processed bigint, "
        "records_inserted bigint, records_updated bigint, records_skipped bigint, errors map<string,string>, "
        "started_at timestamp, finished_at timestamp, duration_seconds int"
    ),
    "concept_normalization": "namespace string, concept string, field string, normalized_concept string, combine string",
    "fx_currencies": "code string, name string",
    "fx_rates": "currency string, rate_date date, usd_per_unit decimal(24,10), source string",
    "data_quality_issues": (
        "company_id string, fiscal_year smallint, field string, issue_type string, severity string, value decimal(38,10)"
    ),
    "index_constituents": (
        "ticker string, start_date date, end_date date, company_id string, source string, loaded_at timestamp"
    ),
}


# What loads note down about their input, beside the tables proper.
RECORDS = {
    "fact_rejects": (
        "run_id string, provider_id string, company_id string, cik string, namespace string, concept string, "
        "value decimal(30,10), unit string, period_start date, period_end date, fiscal_year int, source_id string, "
        "errors string"
    ),
    "document_outcomes": (
        "run_id string, source_identifier string, step string, records_read bigint, records_stored bigint, "
        "records_rejected bigint, records_left_out bigint, records_waiting bigint, error string"
    ),
}


@cache
def schema(name: str) -> StructType:
    """Declared schema of a table (Spark parses it, so a session must run)."""
    return StructType.fromDDL((TABLES | RECORDS)[name])


# Natural keys behind the insert-if-absent writes.
NATURAL_KEYS = {
    "data_providers": ["name"],
    "exchanges": ["code"],
    "company_identifiers": ["company_id", "identifier_type", "provider_id", "identifier_value"],
    "company_listings": ["company_id", "exchange_id", "share_class", "listing_date"],
    "filings": ["provider_id", "accession_number"],
    "financial_facts": ["company_id", "concept", "period_start", "period_end", "filing_id", "source_id"],
    "prices": ["listing_id", "price_date", "provider_id"],
    "dividends": ["listing_id", "ex_date", "provider_id", "source_id"],
    "splits": ["listing_id", "execution_date", "provider_id", "source_id"],
    "raw_documents": ["provider_id", "source_identifier", "checksum"],
    "fx_rates": ["currency", "rate_date"],
    "index_constituents": ["ticker", "start_date"],
    "data_quality_issues": ["company_id", "fiscal_year", "field", "issue_type"],
    "fact_rejects": ["company_id", "namespace", "concept", "unit", "value", "period_start", "period_end", "source_id", "errors"],
    "document_outcomes": ["run_id", "source_identifier", "step"],
}

FACT_VALUE = (
    "struct<`start`:string,`end`:string,val:string,accn:string,fy:int,fp:string,form:string,filed:string,frame:string>"
)
COMPANY_FACTS = (
    "struct<cik:string,entityName:string,facts:map<string,map<string,"
    f"struct<label:string,unit:string,units:map<string,array<{FACT_VALUE}>>>>>>"
)
SUBMISSIONS = (
    "struct<cik:string,name:string,filings:struct<recent:struct<"
    "accessionNumber:array<string>,filingDate:array<string>,reportDate:array<string>,form:array<string>,"
    "primaryDocument:array<string>,primaryDocDescription:array<string>,fy:array<int>,fp:array<string>>>>"
)
