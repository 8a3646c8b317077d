"""Integrity checks. Each returns the offending rows or one row of counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodica import constants
from periodica.operators.aggregates import coverage, distinct_list, duplicates, provenance_counters
from periodica.operators.filters import is_stale
from periodica.schemas import NATURAL_KEYS

Tables = Mapping[str, DataFrame]


def dup_companies(companies: DataFrame) -> DataFrame:
    return duplicates(companies, ["legal_name", "country"])


def shared_cik(identifiers: DataFrame) -> DataFrame:
    """Numbers that stand for several companies."""
    return (
        identifiers.where("identifier_type = 'CIK'")
        .groupBy(F.col("identifier_value").alias("cik"))
        .agg(F.count_distinct("company_id").alias("n_companies"))
        .where("n_companies > 1")
    )


def dup_identifiers(identifiers: DataFrame) -> DataFrame:
    return duplicates(identifiers, ["company_id", "identifier_type", "identifier_value"])


def dup_listings(listings: DataFrame) -> DataFrame:
    return duplicates(listings.where("is_active"), ["company_id", "exchange_id", "ticker"])


def dup_filings(filings: DataFrame) -> DataFrame:
    return duplicates(filings, ["provider_id", "accession_number"])


def dup_facts(facts: DataFrame) -> DataFrame:
    return duplicates(facts, NATURAL_KEYS["financial_facts"])


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Rows whose reference is set or NULL but has no parent row."""
    return child.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphan_listings(listings: DataFrame, companies: DataFrame, exchanges: DataFrame) -> DataFrame:
    known = listings.join(companies.select(F.col("id").alias("company_id")), "company_id", "left_semi").join(
        exchanges.select(F.col("id").alias("exchange_id")), "exchange_id", "left_semi"
    )
    return listings.join(known.select("id"), "id", "left_anti")


def null_values(facts: DataFrame) -> DataFrame:
    return facts.where("value IS NULL")


def childless(companies: DataFrame, child: DataFrame) -> DataFrame:
    return companies.join(child.select(F.col("company_id").alias("id")), "id", "left_anti")


def dangling_filings(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts that name a filing which is not stored."""
    return orphans(facts.where("filing_id IS NOT NULL"), filings, "filing_id")


def _dangling_count(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Number of dangling facts, counted per filing before anything is joined."""
    per_filing = facts.where("filing_id IS NOT NULL").groupBy("filing_id").agg(F.count("*").alias("_n"))
    return orphans(per_filing, filings, "filing_id").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def provenance_gaps(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Counts of facts without provider, filing or source, and with an unknown filing."""
    return provenance_counters(facts).withColumn("dangling_filing_id", _dangling_count(facts, filings).scalar())


def _count(check: str, severity: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n")).select(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), "n"
    )


def _unstack(counts: DataFrame, severity: str) -> DataFrame:
    """One row of counters as (check, severity, n)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in counts.columns])
    return counts.select(F.explode(pairs).alias("p")).select(
        "p.check", F.lit(severity).alias("severity"), "p.n"
    )


def _company_links(child: DataFrame, companies: DataFrame, name: str) -> DataFrame:
    """Orphaned child rows and companies without child; one aggregate serves both, so the child is read once."""
    per_company = child.groupBy("company_id").agg(F.count("*").alias("_n"))
    both = per_company.join(
        companies.select(F.col("id").alias("company_id"), F.lit(True).alias("_known")), "company_id", "full"
    )
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias(f"orphan_{name}"),
        F.count_if(F.col("_n").isNull()).alias(f"companies_without_{name}"),
    )


def _fact_checks(
    facts: DataFrame, companies: DataFrame, filings: DataFrame, counters: Mapping[str, Column]
) -> DataFrame:
    """Duplicate, orphaned and dangling facts, companies without facts, and further counts, in one row.

    The facts are read once: one aggregate folds them by natural key, its rows are rolled
    up to companies and filings, and those meet their tables in one join.
    """
    by_key = facts.groupBy(*NATURAL_KEYS["financial_facts"]).agg(
        F.count("*").alias("_n"), *[F.count_if(c).alias(k) for k, c in counters.items()]
    )
    rolled = by_key.groupingSets([["company_id"], ["filing_id"]], "company_id", "filing_id").agg(
        F.sum("_n").alias("_n"), F.count_if(F.col("_n") >= 2).alias("_repeated"),
        *[F.sum(k).alias(k) for k in counters], F.grouping("company_id").alias("_no_company"),
    )
    company = F.col("_no_company") == 0
    per_id = rolled.select(
        F.when(company, "company").otherwise("filing").alias("_kind"),
        F.when(company, F.col("company_id").cast("string")).otherwise(F.col("filing_id").cast("string")).alias("_id"),
        "_n", "_repeated", *counters,
    )

    def ids(parent: DataFrame, name: str) -> DataFrame:
        return parent.select(F.lit(name).alias("_kind"), F.col("id").cast("string").alias("_id")).distinct()

    parents = ids(companies, "company").unionByName(ids(filings, "filing")).withColumn("_known", F.lit(True))
    both = per_id.join(parents, ["_kind", "_id"], "full")
    of_company, of_filing = F.col("_kind") == "company", (F.col("_kind") == "filing") & F.col("_id").isNotNull()
    zero, unknown = F.lit(0), F.col("_known").isNull()
    return both.agg(
        F.coalesce(F.sum(F.when(of_company, F.col("_repeated"))), zero).alias("dup_facts"),
        F.coalesce(F.sum(F.when(of_company & unknown, F.col("_n"))), zero).alias("orphan_facts"),
        F.count_if(of_company & F.col("_n").isNull()).alias("companies_without_facts"),
        *[F.coalesce(F.sum(F.when(of_company, F.col(k))), zero).alias(k) for k in counters],
        F.coalesce(F.sum(F.when(of_filing & unknown, F.col("_n"))), zero).alias("dangling_filings"),
    )


def integrity_audit(t: Tables) -> DataFrame:
    """All integrity checks as (check, severity, n), zero rows included."""
    facts, filings, companies = t["financial_facts"], t["filings"], t["companies"]
    identifiers, listings = t["company_identifiers"], t["company_listings"]
    missing = {
        "null_values": F.col("value").isNull(),
        "missing_provider_id": F.col("provider_id").isNull(),
        "missing_filing_id": F.col("filing_id").isNull(),
        "missing_source_id": F.col("source_id").isNull(),
    }
    parts = [
        _count("dup_companies", "error", dup_companies(companies)),
        _count("shared_cik", "error", shared_cik(identifiers)),
        _count("dup_identifiers", "error", dup_identifiers(identifiers)),
        _count("dup_listings", "error", dup_listings(listings)),
        _count("dup_filings", "error", dup_filings(filings)),
        _unstack(_fact_checks(facts, companies, filings, missing), "error"),
        _unstack(_company_links(filings, companies, "filings"), "error"),
        _count("orphan_listings", "error", orphan_listings(listings, companies, t["exchanges"])),
        _count("companies_without_identifiers", "error", childless(companies, identifiers)),
    ]
    expected = ("companies_without_facts", "companies_without_filings")
    return reduce(DataFrame.unionByName, parts).withColumn(
        "severity", F.when(F.col("check").isin(*expected), "info").otherwise(F.col("severity"))
    )


def stub_companies(t: Tables, agent_min: int = 4) -> DataFrame:
    """Active companies whose core filings all came in under somebody else's number.

    An accession number starts with the number of whoever submitted it. Prefixes
    that submit for ``agent_min`` companies or more are filing agents, and a company
    they filed for is no stub.
    """
    per_filing = t["financial_facts"].where("filing_id IS NOT NULL").groupBy("filing_id").agg(
        F.count("*").alias("facts")
    )
    core = t["filings"].where(F.col("form").isin(*constants.CORE_FORMS)).select(
        F.col("id").alias("filing_id"), "company_id", F.left("accession_number", F.lit(10)).alias("prefix")
    )
    # One row per company and prefix; the facts are read once for it.
    prefixes = core.join(per_filing, "filing_id").groupBy("company_id", "prefix").agg(F.sum("facts").alias("facts"))
    ciks = t["company_identifiers"].where("identifier_type = 'CIK'").select(
        "company_id", F.col("identifier_value").alias("company_cik")
    ).distinct()
    owned = F.collect_set("company_cik").alias("_own")
    # How many companies a prefix submits for is a window over the small aggregate.
    flagged = (
        prefixes.withColumn("_n", F.count("*").over(Window.partitionBy("prefix")))
        .join(ciks.groupBy("company_id").agg(owned), "company_id")
    )
    # A company's prefixes are its submitters: itself, agents and few others.
    suspects = flagged.groupBy("company_id").agg(
        F.max(F.col("_n") >= agent_min).alias("_served"),
        F.flatten(F.collect_set("_own")).alias("_own"),
        F.collect_set("prefix").alias("_prefixes"), F.sum("facts").alias("n_core_facts"),
    ).where("NOT _served").where(F.size(F.array_except("_own", "_prefixes")) > 0)
    totals = suspects.select(
        "company_id", "n_core_facts", F.array_join(F.array_sort("_prefixes"), ", ").alias("filing_prefixes")
    )
    tickers = t["company_listings"].where("is_active").select("company_id", "ticker").distinct()
    names = t["companies"].select(F.col("id").alias("company_id"), "legal_name")
    return (
        totals.join(names, "company_id").join(ciks, "company_id")
        .join(tickers, "company_id")
        .select("legal_name", "company_cik", "ticker", "n_core_facts", "filing_prefixes")
    )


def multi_cik_tickers(t: Tables) -> DataFrame:
    """Active tickers that lead to several company numbers."""
    rows = (
        t["company_listings"].where("is_active").select("ticker", "company_id")
        .join(t["companies"].select(F.col("id").alias("company_id"), "legal_name"), "company_id")
        .join(
            t["company_identifiers"].where("identifier_type = 'CIK'")
            .select("company_id", F.col("identifier_value").alias("cik")),
            "company_id",
        )
    )
    several = rows.groupBy("ticker").agg(F.count_distinct("cik").alias("n_ciks")).where("n_ciks > 1")
    hit = rows.join(several.select("ticker"), "ticker", "left_semi")
    ciks = distinct_list(hit, ["ticker"], "cik").withColumnRenamed("cik", "ciks")
    names = distinct_list(hit, ["ticker"], "legal_name", " | ").withColumnRenamed("legal_name", "companies")
    return several.join(ciks, "ticker").join(names, "ticker")


def tickers_without_facts(t: Tables) -> DataFrame:
    ciks = t["company_identifiers"].where("identifier_type = 'CIK'").select(
        "company_id", F.col("identifier_value").alias("cik")
    )
    return (
        t["company_listings"].where("is_active").select("company_id", "ticker")
        .join(t["financial_facts"].select("company_id"), "company_id", "left_anti")
        .join(t["companies"].select(F.col("id").alias("company_id"), "legal_name"), "company_id")
        .join(ciks, "company_id", "left")
        .select("ticker", "legal_name", "cik")
    )


def unresolved_universe(universe: DataFrame, t: Tables) -> DataFrame:
    """Wanted tickers that lead to no company number, with the reason."""
    numbered = t["company_identifiers"].where("identifier_type = 'CIK'").select("company_id")
    # Listed tickers with whether any listing reaches a numbered company.
    listed = t["company_listings"].select(F.upper("ticker").alias("_key"), "company_id")
    resolved = listed.join(numbered, "company_id", "left_semi").select("_key", F.lit(True).alias("_ok"))
    known = listed.select("_key", F.lit(False).alias("_ok")).unionByName(resolved).groupBy("_key").agg(
        F.max("_ok").alias("_ok")
    )
    return (
        universe.select("ticker", F.upper("ticker").alias("_key"))
        .join(known, "_key", "left")
        .where("_ok IS NULL OR NOT _ok")
        .select(
            "ticker",
            F.when(F.col("_ok").isNull(), "no company_listings row").otherwise("no CIK identifier").alias("failure"),
        )
    )


def overlapping_listings(listings: DataFrame) -> DataFrame:
    """Closed validity ranges of one company, exchange and share class that touch.

    Counts, per group and start day, the listings that touch one which starts no
    later. Listings are folded per start day first, so a group of any size has at
    most one row per calendar day when it is ordered.
    """
    group = ["company_id", "exchange_id", "share_class"]
    closed = listings.where("listing_date IS NOT NULL AND delisting_date IS NOT NULL AND share_class IS NOT NULL")
    daily = closed.groupBy(*group, "listing_date").agg(
        F.count("*").alias("_n"), F.max("delisting_date").alias("_until")
    )
    before = Window.partitionBy(*group).orderBy("listing_date").rowsBetween(Window.unboundedPreceding, -1)
    touched = F.coalesce(F.max("_until").over(before) >= F.col("listing_date"), F.lit(False))
    return (
        daily.withColumn("n", F.when(touched, F.col("_n")).otherwise(F.col("_n") - 1))
        .where("n > 0")
        .select(*group, "listing_date", "n")
    )


def _row_constraints() -> dict[str, dict[str, Column]]:
    c = F.col
    return {
        "company_identifiers": {"identifier_validity": c("valid_from") > c("valid_to")},
        "filings": {"filing_period": c("period_start") > c("period_end")},
        "financial_facts": {"fact_period": c("period_start") > c("period_end")},
        "dividends": {"dividend_amount": c("amount") < 0, "dividend_dates": c("ex_date") > c("record_date")},
        "splits": {"split_terms": (c("numerator") <= 0) | (c("denominator") <= 0)},
        "import_runs": {"run_status": ~c("status").isin("running", "success", "failed", "partial")},
        "fx_rates": {"fx_rate_positive": c("usd_per_unit") <= 0},
        "index_constituents": {"membership_interval": c("end_date") <= c("start_date")},
    }


def constraint_violations(t: Tables) -> DataFrame:
    """Rows per broken constraint; every table is read once."""
    parts = []
    for name, checks in _row_constraints().items():
        if name in t:
            present = {k: v for k, v in checks.items() if k != "identifier_validity" or "valid_from" in t[name].columns}
            if present:
                parts.append(_unstack(t[name].agg(*[F.count_if(v).alias(k) for k, v in present.items()]), "error"))
    if "company_listings" in t:
        overlap = overlapping_listings(t["company_listings"]).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("overlapping_listings")
        )
        parts.append(_unstack(overlap, "error"))
    return reduce(DataFrame.unionByName, parts)


def history_coverage(t: Tables, targets: DataFrame) -> DataFrame:
    """Covered fiscal years of wanted companies (columns company_name, cik).

    Targets without facts stay, with a count of zero.
    """
    found = targets.join(
        t["company_identifiers"].where("identifier_type = 'CIK'")
        .select(F.col("identifier_value").alias("cik"), "company_id"),
        "cik", "left",
    )
    concerned = t["financial_facts"].join(found.select("company_id"), "company_id", "left_semi")
    per_company = coverage(concerned, ["company_id"])
    return found.join(per_company, "company_id", "left").select(
        "company_name", "cik", "earliest_fiscal_year", "latest_fiscal_year",
        F.coalesce("distinct_fiscal_years", F.lit(0)).alias("distinct_fiscal_years"),
        F.coalesce("total_facts", F.lit(0)).alias("total_facts"),
    )


def stale_companies(t: Tables, now, hours: float, by: str = "activity") -> DataFrame:
    """Companies not refreshed for a number of hours.

    ``activity`` takes the latest of fact, filing and company change times,
    ``synced`` the stored time of the last synchronisation.
    """
    at = F.lit(now).cast("timestamp")
    companies = t["companies"].withColumnRenamed("id", "company_id")
    if by == "synced":
        seen = companies.select("company_id", "legal_name", F.col("last_synced_at").alias("fresh_at"))
    elif by == "activity":
        facts = t["financial_facts"].groupBy("company_id").agg(F.max("created_at").alias("_facts"))
        filings = t["filings"].groupBy("company_id").agg(F.max("created_at").alias("_filings"))
        seen = companies.join(facts, "company_id", "left").join(filings, "company_id", "left").select(
            "company_id", "legal_name", F.greatest("_facts", "_filings", "updated_at").alias("fresh_at")
        )
    else:
        raise ValueError(f"unknown freshness rule {by!r}")
    return seen.where(is_stale(F.col("fresh_at"), at, hours))


def listings_without_prices(t: Tables) -> DataFrame:
    return t["company_listings"].where("is_active").join(
        t["prices"].select(F.col("listing_id").alias("id")), "id", "left_anti"
    ).select("ticker", "id")


def last_price_dates(t: Tables, n: int | None = None) -> DataFrame:
    """Newest price day per ticker, newest first."""
    per_listing = t["prices"].groupBy(F.col("listing_id").alias("id")).agg(F.max("price_date").alias("d"))
    dates = (
        t["company_listings"].select("id", "ticker").join(per_listing, "id")
        .groupBy("ticker").agg(F.max("d").alias("last_price_date"))
    )
    return dates if n is None else dates.orderBy(F.desc("last_price_date"), "ticker").limit(n)


def recent_syncs(t: Tables, n: int) -> DataFrame:
    return (
        t["companies"].where("last_synced_at IS NOT NULL").select("id", "legal_name", "last_synced_at")
        .orderBy(F.desc("last_synced_at"), "id").limit(n)
    )


def recent_runs(t: Tables, provider_id, n: int) -> DataFrame:
    return (
        t["import_runs"].where(F.col("provider_id") == provider_id)
        .select("id", "status", "records_inserted", "finished_at")
        .orderBy(F.col("finished_at").desc_nulls_first(), F.desc("id")).limit(n)
    )


def freshness_report(t: Tables, now, hours: float = 48.0) -> DataFrame:
    """Counts behind the daily monitoring: stale companies, unpriced listings, open runs."""
    running = t["import_runs"].where("status = 'running'")
    return reduce(
        DataFrame.unionByName,
        [
            _count("stale_companies", "warning", stale_companies(t, now, hours, "synced")),
            _count("listings_without_prices", "warning", listings_without_prices(t)),
            _count("runs_open", "info", running),
        ],
    )


def audit_all(t: Tables) -> DataFrame:
    """Integrity and constraint checks in one result."""
    return integrity_audit(t).unionByName(constraint_violations(t))


def duplicates_of(t: Tables, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of a table that repeat its natural key."""
    return duplicates(t[name], keys or NATURAL_KEYS[name])
