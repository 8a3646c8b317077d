"""Company analysis, history, membership and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.plans import analytics, history, lookups
from periodica.sources.series import parse_membership
from periodica.workload.registry import query
from periodica.workload.views import Views


def _tags(metric: str, tags: dict = constants.ANALYSIS_TAGS) -> str:
    return ", ".join(f"'{t}'" for t in tags[metric])


def _pivot(metrics, zero, tags: dict = constants.ANALYSIS_TAGS) -> str:
    parts = []
    for m in metrics:
        best = f"max(CASE WHEN f.concept IN ({_tags(m, tags)}) THEN f.value END)"
        parts.append(f"coalesce({best}, 0) AS {m}" if m in zero else f"{best} AS {m}")
    return ", ".join(parts)


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) * 100 END"


def _div(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _growth(a: str, b: str) -> str:
    return (
        f"CASE WHEN {b} <> 0 THEN (CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) / CAST({b} AS DOUBLE) * 100 END"
    )


_CIKS = """ciks AS (SELECT company_id, identifier_value AS cik FROM {company_identifiers} WHERE identifier_type = 'CIK')"""
_SERIES = ("revenue", "net_income", "total_assets", "stockholders_equity", "total_liabilities",
           "operating_cash_flow", "capex")


@query(
    f"""WITH {_CIKS}
    SELECT ci.cik, c.legal_name, c.sector, c.industry, c.country, f.earliest_fiscal_year, f.latest_fiscal_year,
           coalesce(f.n, 0) AS total_facts, coalesce(n.n, 0) AS total_filings
    FROM ciks ci JOIN {{companies}} c ON c.id = ci.company_id
    LEFT JOIN (SELECT company_id, min(fiscal_year) AS earliest_fiscal_year, max(fiscal_year) AS latest_fiscal_year,
                      count(*) AS n FROM {{financial_facts}} GROUP BY 1) f ON f.company_id = c.id
    LEFT JOIN (SELECT company_id, count(*) AS n FROM {{filings}} GROUP BY 1) n ON n.company_id = c.id""",
    longs="total_facts total_filings",
)
def company_overview(v: Views) -> DataFrame:
    return analytics.company_overview(v)


@query(
    f"""WITH {_CIKS},
    years AS (SELECT ci.cik, f.fiscal_year, {_pivot(_SERIES, _SERIES)}
              FROM {{financial_facts}} f JOIN ciks ci ON f.company_id = ci.company_id
              WHERE f.fiscal_year > 0 GROUP BY 1, 2),
    calc AS (SELECT *, operating_cash_flow - capex AS free_cash_flow,
                    lag(revenue) OVER w AS p_revenue, lag(net_income) OVER w AS p_income,
                    lag(total_assets) OVER w AS p_assets
             FROM years WINDOW w AS (PARTITION BY cik ORDER BY fiscal_year))
    SELECT cik, fiscal_year, {", ".join(_SERIES)}, free_cash_flow,
           {_growth("revenue", "p_revenue")} AS revenue_growth_pct,
           {_growth("net_income", "p_income")} AS net_income_growth_pct,
           {_growth("total_assets", "p_assets")} AS total_assets_growth_pct,
           {_pct("net_income", "revenue")} AS net_margin_pct,
           {_pct("operating_cash_flow", "revenue")} AS operating_margin_pct,
           {_pct("free_cash_flow", "revenue")} AS fcf_margin_pct
    FROM calc""",
    doubles=" ".join(_SERIES) + " free_cash_flow revenue_growth_pct net_income_growth_pct total_assets_growth_pct "
    "net_margin_pct operating_margin_pct fcf_margin_pct",
)
def financial_series(v: Views) -> DataFrame:
    return analytics.financial_series(v)


_SHOWN = ("revenue", "net_income", "total_assets", "stockholders_equity", "total_liabilities")
_OPTIONAL = ("current_assets", "current_liabilities", "shares_outstanding")


@query(
    f"""WITH {_CIKS},
    years AS (SELECT f.company_id, f.fiscal_year, {_pivot((*_SHOWN, *_OPTIONAL), _SHOWN)}
              FROM {{financial_facts}} f WHERE f.fiscal_year > 0 GROUP BY 1, 2),
    newest AS (SELECT listing_id, arg_max(close, price_date) AS close FROM {{prices}} GROUP BY 1),
    quoted AS (SELECT cl.company_id, n.close AS price FROM {{company_listings}} cl LEFT JOIN newest n ON n.listing_id = cl.id
               WHERE cl.is_active AND cl.is_primary)
    SELECT ci.cik, y.fiscal_year, {", ".join(_SHOWN)},
           {_pct("net_income", "stockholders_equity")} AS roe_pct, {_pct("net_income", "total_assets")} AS roa_pct,
           {_pct("net_income", "revenue")} AS net_margin_pct,
           {_div("total_liabilities", "stockholders_equity")} AS debt_to_equity,
           {_div("total_liabilities", "total_assets")} AS debt_to_assets,
           {_div("current_assets", "current_liabilities")} AS current_ratio,
           CASE WHEN shares_outstanding <> 0 THEN price * CAST(shares_outstanding AS DOUBLE) END AS market_cap,
           CASE WHEN shares_outstanding <> 0 AND net_income <> 0
                THEN price * CAST(shares_outstanding AS DOUBLE) / CAST(net_income AS DOUBLE) END AS pe_ratio
    FROM years y JOIN ciks ci ON ci.company_id = y.company_id LEFT JOIN quoted q ON q.company_id = y.company_id""",
    doubles=" ".join(_SHOWN) + " roe_pct roa_pct net_margin_pct debt_to_equity debt_to_assets current_ratio "
    "market_cap pe_ratio",
)
def ratios(v: Views) -> DataFrame:
    return analytics.ratios(v)


_COMPARED = ("revenue", "net_income", "stockholders_equity", "total_liabilities")


@query(
    f"""WITH {_CIKS},
    years AS (SELECT ci.cik, f.fiscal_year, {_pivot(_COMPARED, _COMPARED)}
              FROM {{financial_facts}} f JOIN ciks ci ON f.company_id = ci.company_id
              WHERE f.fiscal_year > 0 GROUP BY 1, 2),
    latest AS (SELECT * FROM years QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC) = 1)
    SELECT l.cik, l.fiscal_year AS latest_fiscal_year, l.revenue, l.net_income,
           {_pct("l.net_income", "l.stockholders_equity")} AS roe_pct, {_pct("l.net_income", "l.revenue")} AS net_margin_pct,
           {_div("l.total_liabilities", "l.stockholders_equity")} AS debt_to_equity,
           {_growth("l.revenue", "p.revenue")} AS revenue_growth_pct
    FROM latest l LEFT JOIN years p ON p.cik = l.cik AND p.fiscal_year = l.fiscal_year - 1""",
    doubles="revenue net_income roe_pct net_margin_pct debt_to_equity revenue_growth_pct",
)
def compare_companies(v: Views) -> DataFrame:
    return analytics.compare(v)


_SNAP = tuple(constants.SNAPSHOT_TAGS)


@query(
    f"""WITH {_CIKS},
    years AS (SELECT f.company_id, f.fiscal_year, {_pivot(_SNAP, _SNAP, constants.SNAPSHOT_TAGS)}
              FROM {{financial_facts}} f
              WHERE f.fiscal_period = 'FY' AND f.unit = 'USD'
                AND f.company_id IN (SELECT l.company_id FROM {{company_listings}} l JOIN ciks ON ciks.company_id = l.company_id
                                     WHERE l.is_active)
              GROUP BY 1, 2)
    SELECT company_id, fiscal_year, {", ".join(_SNAP)} FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY fiscal_year DESC) AS rn FROM years) r
    WHERE rn = 1""",
    doubles=" ".join(_SNAP),
)
def latest_annual(v: Views) -> DataFrame:
    return analytics.latest_annual(v)


_TIES = "filing_date DESC, period_end DESC, period_start DESC NULLS LAST, source_id DESC, value DESC"
_FACT = "company_id, fiscal_year, concept, value, unit, period_end, filing_date, source_id"


@query(
    f"""SELECT DISTINCT ON (company_id, fiscal_year, concept) {_FACT}, DATE '1999-06-30' AS as_of
    FROM {{financial_facts}} WHERE filing_date <= DATE '1999-06-30' AND period_end <= DATE '1999-06-30'
    ORDER BY company_id, fiscal_year, concept, {_TIES}""",
    doubles="value",
)
def pit_facts(v: Views) -> DataFrame:
    """Facts as they were public on one day."""
    return history.facts_as_of(v["financial_facts"], "1999-06-30").select(*_FACT.split(", "), "as_of")


_DAYS = """days AS (SELECT DISTINCT make_date(year(o_orderdate), 6, 30) AS as_of FROM {orders}
    UNION SELECT DISTINCT make_date(year(o_orderdate), 12, 31) FROM {orders})"""


def half_years(v: Views) -> DataFrame:
    years = v["orders"].select(F.year("o_orderdate").alias("y")).distinct()
    return years.select(
        F.explode(
            F.array(F.make_date("y", F.lit(6), F.lit(30)), F.make_date("y", F.lit(12), F.lit(31)))
        ).alias("as_of")
    )


@query(
    f"""WITH {_DAYS}
    SELECT DISTINCT ON (as_of, company_id, fiscal_year, concept) as_of, {_FACT}
    FROM {{financial_facts}} f JOIN days d ON f.filing_date <= d.as_of AND f.period_end <= d.as_of
    ORDER BY as_of, company_id, fiscal_year, concept, {_TIES}""",
    doubles="value",
)
def pit_facts_dates(v: Views) -> DataFrame:
    """Facts as public on each half-year end, through version intervals."""
    wanted = _FACT.split(", ")
    return history.facts_as_of(v["financial_facts"], half_years(v), columns=wanted).select("as_of", *wanted)


_MEMBERS = """SELECT DISTINCT d.as_of, m.ticker, m.company_id FROM days d
    JOIN {membership} m ON m.start_date <= d.as_of AND (m.end_date IS NULL OR m.end_date > d.as_of)"""


@query(f"WITH {_DAYS} {_MEMBERS}")
def members_at(v: Views) -> DataFrame:
    return history.members_at(v["membership"], half_years(v))


@query(
    """WITH days AS (SELECT DISTINCT make_date(year(start_date), 12, 31) AS as_of FROM {membership})
    SELECT d.as_of, count(DISTINCT m.ticker) AS members, count(DISTINCT m.ticker) BETWEEN 450 AND 520 AS plausible
    FROM days d LEFT JOIN {membership} m ON m.start_date <= d.as_of AND (m.end_date IS NULL OR m.end_date > d.as_of)
    GROUP BY 1""",
    longs="members",
)
def membership_sanity(v: Views) -> DataFrame:
    return history.membership_sanity(v["membership"])


_UNIVERSE = f"""WITH {_DAYS}, members AS ({_MEMBERS}),
    known AS (SELECT DISTINCT ON (as_of, company_id, fiscal_year, concept) as_of, {_FACT}
              FROM {{financial_facts}} f JOIN days d ON f.filing_date <= d.as_of AND f.period_end <= d.as_of
              ORDER BY as_of, company_id, fiscal_year, concept, {_TIES})"""


@query(f"{_UNIVERSE} SELECT m.ticker, k.* FROM known k JOIN members m USING (as_of, company_id)", doubles="value")
def pit_universe(v: Views) -> DataFrame:
    """Members on each half-year end with their facts as public then."""
    wanted = _FACT.split(", ")
    return history.pit_universe(v["membership"], v["financial_facts"], half_years(v), wanted).select(
        "ticker", "as_of", *wanted
    )


def _feed(v: Views) -> DataFrame:
    """Membership rows as the CSV text of the feed: dotted tickers, repeated starts, bad intervals."""
    end = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(
        F.date_add(F.col("o_orderdate").cast("date"), F.col("o_orderkey").cast("int") % 90 - 5).cast("string")
    )
    return v["orders"].join(v["company_listings"], v["orders"]["o_custkey"] == v["company_listings"]["company_id"]).select(
        F.concat(F.lit(' "'), F.lower("ticker"), F.lit('.a" ')).alias("ticker"),
        F.col("o_orderdate").cast("date").cast("string").alias("start_date"), end.alias("end_date"),
    )


_PARSED = """parsed AS (
      SELECT upper(l.ticker) || '-A' AS ticker, CAST(o.o_orderdate AS DATE) AS start_date,
             CASE WHEN count(*) FILTER (WHERE o.o_orderstatus = 'O') > 0 THEN NULL
                  ELSE max(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 90 - 5 AS INTEGER)) END AS end_date
      FROM {orders} o JOIN {company_listings} l ON o.o_custkey = l.company_id
      WHERE o.o_orderstatus = 'O' OR o.o_orderkey % 90 - 5 > 0 GROUP BY 1, 2)"""


@query(f"WITH {_PARSED} SELECT * FROM parsed")
def widest_interval(v: Views) -> DataFrame:
    """Membership feed parsed, the widest interval per ticker and start kept."""
    return parse_membership(_feed(v))


_RESOLVED = """resolved AS (SELECT DISTINCT ON (upper(ticker)) upper(ticker) || '-A' AS ticker, company_id FROM {company_listings}
      ORDER BY upper(ticker), is_active DESC, is_primary DESC, listing_date DESC NULLS LAST, company_id)"""


def _feed_listings(v: Views) -> DataFrame:
    return v["company_listings"].withColumn("ticker", F.concat("ticker", F.lit("-a")))


@query(
    f"WITH {_PARSED}, {_RESOLVED} SELECT p.*, r.company_id, 'feed' AS source FROM parsed p LEFT JOIN resolved r USING (ticker)"
)
def membership_load(v: Views) -> DataFrame:
    """Membership rows as stored: parsed, deduplicated, matched to companies."""
    rows = history.membership_rows(parse_membership(_feed(v)), _feed_listings(v), "feed", "2020-01-01")
    return rows.drop("loaded_at")


@query(
    f"""WITH {_PARSED}, {_RESOLVED}
    SELECT count(*) AS rows, count(DISTINCT ticker) AS tickers, count(company_id) AS resolved,
           count(*) FILTER (WHERE company_id IS NULL) AS unresolved, min(start_date) AS first_date,
           max(coalesce(end_date, start_date)) AS last_date
    FROM parsed LEFT JOIN resolved USING (ticker)""",
    longs="rows tickers resolved unresolved",
)
def membership_stats(v: Views) -> DataFrame:
    return history.membership_stats(
        history.membership_rows(parse_membership(_feed(v)), _feed_listings(v), "feed", "2020-01-01")
    )


@query(
    """SELECT f.company_id, f.concept, f.value, f.unit, f.period_start, f.period_end, f.fiscal_year, f.fiscal_period,
           f.filing_id, f.source_id, fi.form AS filing_form, fi.accession_number, fi.filing_date AS filed_on,
           rd.storage_path AS raw_file, p.name AS provider_name, p.type AS provider_type
    FROM {financial_facts} f JOIN {filings} fi ON f.filing_id = fi.id JOIN {data_providers} p ON p.id = f.provider_id
    LEFT JOIN {raw_documents} rd ON rd.id = fi.raw_document_id""",
    doubles="value",
)
def facts_provenance(v: Views) -> DataFrame:
    return lookups.facts_with_provenance(v)


@query(
    """SELECT listing_id, price_date, open, high, low, close, volume FROM {prices}
    WHERE price_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    doubles="open high low close", longs="volume",
)
def price_history(v: Views) -> DataFrame:
    return lookups.prices(v, since="2024-01-05", until="2024-01-20").drop("provider_id")


@query(
    """SELECT listing_id, price_date, close FROM (
      SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY price_date DESC) AS rn FROM {prices}) r WHERE rn = 1""",
    doubles="close",
)
def price_latest(v: Views) -> DataFrame:
    return lookups.prices(v, latest=True).select("listing_id", "price_date", "close")


@query(
    """SELECT d.* FROM {dividends} d WHERE listing_id IN (SELECT id FROM {company_listings} WHERE is_active)
      AND ex_date >= DATE '2024-01-10'""",
    doubles="amount",
)
def dividend_history(v: Views) -> DataFrame:
    active = v["company_listings"].where("is_active").select(F.col("id").alias("listing_id"))
    return lookups.dividends(v, active, since="2024-01-10")


@query(
    """SELECT s.* FROM {splits} s WHERE listing_id IN (SELECT id FROM {company_listings} WHERE is_active)
      AND execution_date <= DATE '2024-01-20'"""
)
def split_history(v: Views) -> DataFrame:
    active = v["company_listings"].where("is_active").select(F.col("id").alias("listing_id"))
    return lookups.splits(v, active, until="2024-01-20")


@query(
    """SELECT company_id, concept, value, filing_date, source_id, legal_name FROM (
      SELECT f.*, c.legal_name, row_number() OVER (PARTITION BY f.company_id, f.concept
             ORDER BY f.filing_date DESC, f.period_end DESC, f.source_id DESC, f.value DESC) AS rn
      FROM {financial_facts} f JOIN {companies} c ON f.company_id = c.id
      WHERE f.company_id IN (SELECT id FROM {companies} WHERE is_active)) r WHERE rn = 1""",
    doubles="value",
)
def facts_latest_by_concept(v: Views) -> DataFrame:
    """Last filed fact per company and concept for a relation of companies."""
    wanted = v["companies"].where("is_active").select(F.col("id").alias("company_id"))
    return lookups.facts_for(v, wanted, latest=True).select(
        "company_id", "concept", "value", "filing_date", "source_id", "legal_name"
    )


@query(
    """SELECT f.company_id, f.concept, f.value, f.source_id, c.legal_name
    FROM {financial_facts} f JOIN {companies} c ON f.company_id = c.id
    WHERE f.period_start IS NULL AND (f.company_id, f.concept) IN (SELECT (id, 'Assets') FROM {companies})""",
    doubles="value",
)
def facts_instant(v: Views) -> DataFrame:
    """Balance-sheet values for (company, concept) pairs."""
    wanted = v["companies"].select(F.col("id").alias("company_id"), F.lit("Assets").alias("concept"))
    return lookups.facts_for(v, wanted, instant=True).select("company_id", "concept", "value", "source_id", "legal_name")


@query(
    """SELECT i.* FROM {company_identifiers} i
    WHERE (identifier_type, identifier_value) IN (SELECT ('TICKER', ticker) FROM {company_listings} WHERE is_active)"""
)
def lookup_identifiers(v: Views) -> DataFrame:
    wanted = v["company_listings"].where("is_active").select(
        F.lit("TICKER").alias("identifier_type"), F.col("ticker").alias("identifier_value")
    )
    return lookups.lookup(v, "identifier", wanted)


@query(
    """SELECT id, company_id, form, accession_number, filing_date FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY filing_date DESC, accession_number DESC) AS rn
      FROM {filings}) r WHERE rn <= 3"""
)
def lookup_recent_filings(v: Views) -> DataFrame:
    return lookups.recent_filings(v, 3).select("id", "company_id", "form", "accession_number", "filing_date")


@query(
    """SELECT id, company_id, ticker, exchange_id FROM {company_listings} l
    WHERE EXISTS (SELECT 1 FROM {prices} p JOIN {company_listings} k ON k.id = p.listing_id WHERE k.ticker = l.ticker)"""
)
def lookup_listings(v: Views) -> DataFrame:
    """Listings by ticker: every listing that shares its ticker with a priced one."""
    priced = v["prices"].select(F.col("listing_id").alias("id"))
    wanted = v["company_listings"].join(priced, "id", "left_semi").select("ticker").distinct()
    return lookups.lookup(v, "listing", wanted).select("id", "company_id", "ticker", "exchange_id")


@query(
    """SELECT f.id, f.form, f.accession_number FROM {filings} f JOIN {orders} o ON o.o_orderkey = f.id
    WHERE o.o_orderstatus = 'P'"""
)
def lookup_filings(v: Views) -> DataFrame:
    """Filings by provider and accession number."""
    pending = v["orders"].where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    wanted = v["filings"].join(pending, "id", "left_semi").select("provider_id", "accession_number")
    return lookups.lookup(v, "filing", wanted).select("id", "form", "accession_number")


@query(
    """SELECT e.id, e.code, e.name FROM {exchanges} e WHERE e.code IN (SELECT exchange_id FROM {company_listings} WHERE is_primary)"""
)
def lookup_exchanges(v: Views) -> DataFrame:
    wanted = v["company_listings"].where("is_primary").select(F.col("exchange_id").alias("code")).distinct()
    return lookups.lookup(v, "exchange", wanted).select("id", "code", "name")


@query(
    """SELECT id, name, type FROM {data_providers} WHERE name IN (SELECT 'Provider ' || r_name FROM {region} WHERE r_name LIKE 'A%')"""
)
def lookup_providers(v: Views) -> DataFrame:
    wanted = v["region"].where("r_name LIKE 'A%'").select(F.concat(F.lit("Provider "), "r_name").alias("name"))
    return lookups.lookup(v, "provider", wanted)


@query("SELECT id, legal_name, country FROM {companies} WHERE is_active ORDER BY legal_name, id LIMIT 100 OFFSET 200")
def company_page(v: Views) -> DataFrame:
    """Active companies by name: the third page of one hundred."""
    return lookups.company_page(v, 100, 200).select("id", "legal_name", "country")
