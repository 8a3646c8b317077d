"""Per-company analysis: overview, yearly series, ratios, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions.money import percent, ratio
from periodica.operators.aggregates import alias_pivot
from periodica.operators.windows import growth_exact, growth_lag, latest_by, latest_year

Tables = Mapping[str, DataFrame]


def cik_companies(t: Tables, ciks: Sequence[str] | DataFrame | None = None, provider: str | None = None) -> DataFrame:
    """Companies by number: all, the listed ones, or those of a key relation."""
    found = t["company_identifiers"].where("identifier_type = 'CIK'")
    if provider is not None:
        found = found.where(F.col("provider_id") == provider)
    found = found.select("company_id", F.col("identifier_value").alias("cik")).distinct()
    if isinstance(ciks, DataFrame):
        return found.join(ciks.select("cik"), "cik", "left_semi")
    return found if ciks is None else found.where(F.col("cik").isin(*ciks))


def _yearly(
    t: Tables, companies: DataFrame, metrics: Sequence[str], zero: Sequence[str],
    restricted: bool, fiscal_period: str | None,
) -> DataFrame:
    facts = t["financial_facts"].where("fiscal_year > 0")
    tags = {m: constants.ANALYSIS_TAGS[m] for m in metrics}
    if fiscal_period:
        facts = facts.where(F.col("fiscal_period") == fiscal_period)
    if restricted:
        facts = facts.join(companies.select("company_id"), "company_id", "left_semi")
    # Years without any of the tags still count, so the tags are no row filter.
    pivoted = alias_pivot(facts, ["company_id", "fiscal_year"], tags, dict.fromkeys(zero, 0))
    return pivoted.join(companies, "company_id")


def company_overview(t: Tables, ciks: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Profile with covered years and numbers of facts and filings.

    Both counts are taken per table before joining; the rows of one never
    multiply those of the other.
    """
    facts = t["financial_facts"].groupBy("company_id").agg(
        F.min("fiscal_year").alias("earliest_fiscal_year"),
        F.max("fiscal_year").alias("latest_fiscal_year"),
        F.count("*").alias("total_facts"),
    )
    filings = t["filings"].groupBy("company_id").agg(F.count("*").alias("total_filings"))
    return (
        cik_companies(t, ciks)
        .join(t["companies"].withColumnRenamed("id", "company_id"), "company_id")
        .join(facts, "company_id", "left")
        .join(filings, "company_id", "left")
        .select(
            "cik", "legal_name", "sector", "industry", "country",
            "earliest_fiscal_year", "latest_fiscal_year",
            F.coalesce("total_facts", F.lit(0)).alias("total_facts"),
            F.coalesce("total_filings", F.lit(0)).alias("total_filings"),
        )
    )


def financial_series(
    t: Tables, ciks: Sequence[str] | DataFrame | None = None, fiscal_period: str | None = None
) -> DataFrame:
    """Yearly metrics with growth against the previous reported year and margins."""
    metrics = (
        "revenue", "net_income", "total_assets", "stockholders_equity",
        "total_liabilities", "operating_cash_flow", "capex",
    )
    companies = cik_companies(t, ciks)
    years = _yearly(t, companies, metrics, metrics, ciks is not None, fiscal_period)
    years = years.withColumn("free_cash_flow", F.col("operating_cash_flow") - F.col("capex"))
    grown = growth_lag(years, ["cik"], "fiscal_year", ["revenue", "net_income", "total_assets"])
    c = F.col
    return grown.select(
        "cik", "fiscal_year", *metrics, "free_cash_flow",
        "revenue_growth_pct", "net_income_growth_pct", "total_assets_growth_pct",
        percent(c("net_income"), c("revenue")).alias("net_margin_pct"),
        percent(c("operating_cash_flow"), c("revenue")).alias("operating_margin_pct"),
        percent(c("free_cash_flow"), c("revenue")).alias("fcf_margin_pct"),
    )


def latest_prices(t: Tables, provider: str | None = None) -> DataFrame:
    """Newest close per listing."""
    prices = t["prices"]
    if provider is not None:
        prices = prices.where(F.col("provider_id") == provider)
    return latest_by(
        prices.select("listing_id", "price_date", "close"), ["listing_id"], ["price_date", "close"]
    )


def ratios(
    t: Tables,
    ciks: Sequence[str] | DataFrame | None = None,
    price_provider: str | None = None,
    fiscal_period: str | None = None,
) -> DataFrame:
    """Yearly returns, leverage, liquidity and valuation.

    Valuation uses the newest price of the company's primary active listing for
    every year. The price comes through the listing, not through the ticker text.
    """
    shown = ("revenue", "net_income", "total_assets", "stockholders_equity", "total_liabilities")
    optional = ("current_assets", "current_liabilities", "shares_outstanding")
    companies = cik_companies(t, ciks)
    years = _yearly(t, companies, (*shown, *optional), shown, ciks is not None, fiscal_period)
    quoted = (
        t["company_listings"].where("is_active AND is_primary")
        .select("company_id", F.col("id").alias("listing_id"))
        .join(latest_prices(t, price_provider), "listing_id", "left")
        .select("company_id", F.col("close").cast("double").alias("latest_price"))
    )
    c = F.col
    shares = F.nullif(c("shares_outstanding"), F.lit(0)).cast("double")
    cap = c("latest_price") * shares
    return years.join(quoted, "company_id", "left").select(
        "cik", "fiscal_year", *shown,
        percent(c("net_income"), c("stockholders_equity")).alias("roe_pct"),
        percent(c("net_income"), c("total_assets")).alias("roa_pct"),
        percent(c("net_income"), c("revenue")).alias("net_margin_pct"),
        ratio(c("total_liabilities"), c("stockholders_equity")).alias("debt_to_equity"),
        ratio(c("total_liabilities"), c("total_assets")).alias("debt_to_assets"),
        ratio(c("current_assets"), c("current_liabilities")).alias("current_ratio"),
        cap.alias("market_cap"),
        ratio(cap, c("net_income")).alias("pe_ratio"),
    )


def compare(
    t: Tables, ciks: Sequence[str] | DataFrame | None = None, fiscal_period: str | None = None
) -> DataFrame:
    """Latest fiscal year of each company side by side, by revenue.

    Revenue growth is against exactly the year before.
    """
    metrics = ("revenue", "net_income", "stockholders_equity", "total_liabilities")
    companies = cik_companies(t, ciks)
    years = _yearly(t, companies, metrics, metrics, ciks is not None, fiscal_period)
    latest = latest_year(growth_exact(years, ["cik"], "fiscal_year", ["revenue"]), ["cik"])
    c = F.col
    return latest.select(
        "cik", c("fiscal_year").alias("latest_fiscal_year"), "revenue", "net_income",
        percent(c("net_income"), c("stockholders_equity")).alias("roe_pct"),
        percent(c("net_income"), c("revenue")).alias("net_margin_pct"),
        ratio(c("total_liabilities"), c("stockholders_equity")).alias("debt_to_equity"),
        "revenue_growth_pct",
    ).orderBy(c("revenue").desc_nulls_last(), "cik")


def latest_annual(t: Tables, ciks: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Newest full-year dollar figures of companies with an active listing."""
    facts = t["financial_facts"].where("fiscal_period = 'FY' AND unit = 'USD'")
    listed = cik_companies(t, ciks).join(t["company_listings"].where("is_active"), "company_id", "left_semi")
    if ciks is not None:
        facts = facts.join(listed.select("company_id"), "company_id", "left_semi")
    metrics = alias_pivot(
        facts, ["company_id", "fiscal_year"], constants.SNAPSHOT_TAGS, dict.fromkeys(constants.SNAPSHOT_TAGS, 0)
    )
    return latest_year(metrics, ["company_id"]).join(listed.select("company_id"), "company_id", "left_semi")
