"""The building blocks one by one: filters, joins, aggregates, windows, paging, writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions import keys, money
from periodica.operators import aggregates, filters, joins, paging, windows, writes
from periodica.plans import core
from periodica.workload.layers import CODES, MAPPING, MATCH
from periodica.workload.registry import query
from periodica.workload.views import Views

# --- filters ------------------------------------------------------------------


@query(
    """SELECT id, form, filing_date FROM {filings}
    WHERE form IN ('10-K', '20-F') AND filing_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"""
)
def filter_in_between(v: Views) -> DataFrame:
    found = filters.where_in(v["filings"], "form", ["10-K", "20-F"])
    return filters.between_dates(found, "filing_date", "1996-01-01", "1998-12-31").select("id", "form", "filing_date")


@query("SELECT id, form FROM {filings} WHERE form <> ALL (SELECT unnest(['10-K', '10-Q']))")
def filter_not_in(v: Views) -> DataFrame:
    return filters.where_in(v["filings"], "form", ["10-K", "10-Q"], negate=True).select("id", "form")


@query(
    """SELECT source_id, concept FROM {financial_facts}
    WHERE company_id IN (SELECT id FROM {companies} WHERE sector = 'MACHINERY')"""
)
def filter_in_subquery(v: Views) -> DataFrame:
    wanted = v["companies"].where("sector = 'MACHINERY'").select("id")
    return filters.in_subquery(v["financial_facts"], "company_id", wanted).select("source_id", "concept")


_LAST_YEAR = "SELECT company_id, max(fiscal_year) FROM {financial_facts} GROUP BY company_id"


@query(
    """SELECT f.source_id, f.company_id, f.fiscal_year FROM {financial_facts} f
    JOIN (SELECT company_id, max(fiscal_year) AS fiscal_year FROM {financial_facts} GROUP BY company_id) l
      ON f.company_id = l.company_id AND f.fiscal_year = l.fiscal_year"""
)
def filter_tuple_in(v: Views) -> DataFrame:
    """Facts of each company's last year, by a (company, year) tuple."""
    last = v["financial_facts"].groupBy("company_id").agg(F.max("fiscal_year").alias("y"))
    return filters.tuple_in(v["financial_facts"], ["company_id", "fiscal_year"], last).select(
        "source_id", "company_id", "fiscal_year"
    )


@query("SELECT id, name FROM {exchanges} WHERE id = (SELECT max(exchange_id) FROM {company_listings})")
def filter_scalar_subquery(v: Views) -> DataFrame:
    last = v["company_listings"].agg(F.max("exchange_id").alias("m"))
    return v["exchanges"].where(F.col("id") == filters.scalar_of(last, "m")).select("id", "name")


@query(
    """SELECT p.listing_id, p.price_date, p.close FROM {prices} p
    WHERE p.price_date = (SELECT max(q.price_date) FROM {prices} q WHERE q.listing_id = p.listing_id)""",
    doubles="close",
)
def filter_group_max(v: Views) -> DataFrame:
    """Correlated maximum, as one aggregate and a semi join."""
    return filters.at_group_max(v["prices"], ["listing_id"], "price_date").select("listing_id", "price_date", "close")


@query(
    """SELECT c.id, c.legal_name FROM {companies} c
    WHERE EXISTS (SELECT 1 FROM {filings} f WHERE f.company_id = c.id AND f.form = '10-K')
      AND NOT EXISTS (SELECT 1 FROM {prices} p WHERE p.listing_id = c.id)"""
)
def filter_exists(v: Views) -> DataFrame:
    reported = v["filings"].where("form = '10-K'").select(F.col("company_id").alias("id"))
    priced = v["prices"].select(F.col("listing_id").alias("id"))
    found = filters.not_exists(filters.exists(v["companies"], reported, ["id"]), priced, ["id"])
    return found.select("id", "legal_name")


@query("SELECT id, sector FROM {companies} WHERE sector IS NOT DISTINCT FROM nullif('none', 'none')")
def filter_null_safe(v: Views) -> DataFrame:
    return v["companies"].where(filters.null_safe_eq(F.col("sector"), F.lit(None))).select("id", "sector")


@query("SELECT source_id, unit FROM {financial_facts} WHERE regexp_matches(unit, '^[A-Z]{{3}}(/shares)?$')")
def filter_unit_regex(v: Views) -> DataFrame:
    return v["financial_facts"].where(money.unit_is_currency(F.col("unit"))).select("source_id", "unit")


@query(
    """SELECT ticker, start_date, end_date FROM {membership}
    WHERE start_date <= DATE '1998-03-01' AND (end_date IS NULL OR end_date > DATE '1998-03-01')"""
)
def filter_contains_date(v: Views) -> DataFrame:
    hit = filters.contains_date(F.col("start_date"), F.col("end_date"), F.lit("1998-03-01").cast("date"))
    return v["membership"].where(hit).select("ticker", "start_date", "end_date")


@query(
    """SELECT id FROM {companies} WHERE last_synced_at IS NULL
      OR last_synced_at < TIMESTAMP '2001-07-01 12:00:00' - INTERVAL 36 HOUR"""
)
def filter_stale(v: Views) -> DataFrame:
    now = F.lit("2001-07-01 12:00:00").cast("timestamp")
    return v["companies"].where(filters.is_stale(F.col("last_synced_at"), now, 36)).select("id")


@query("SELECT id, ticker FROM {company_listings} WHERE is_active AND delisting_date IS NULL")
def filter_active(v: Views) -> DataFrame:
    return filters.undelisted(filters.active_listings(v["company_listings"])).select("id", "ticker")


@query("SELECT source_id, concept FROM {financial_facts} WHERE period_start IS NULL AND concept = 'Liabilities'")
def filter_instant(v: Views) -> DataFrame:
    return filters.instant_facts(v["financial_facts"], "Liabilities").select("source_id", "concept")


# --- joins --------------------------------------------------------------------


@query(
    """SELECT l.id, l.ticker, e.name, c.legal_name FROM {company_listings} l JOIN {exchanges} e ON e.id = l.exchange_id
    JOIN {companies} c ON c.id = l.company_id"""
)
def join_lookup(v: Views) -> DataFrame:
    listings = v["company_listings"].select("id", "ticker", "exchange_id", "company_id")
    exchanges = v["exchanges"].select(F.col("id").alias("exchange_id"), "name")
    companies = v["companies"].select(F.col("id").alias("company_id"), "legal_name")
    found = joins.lookup_join(joins.lookup_join(listings, exchanges, "exchange_id"), companies, "company_id")
    return found.select("id", "ticker", "name", "legal_name")


@query("SELECT c.id, p.price_date, p.close FROM {companies} c LEFT JOIN {prices} p ON p.listing_id = c.id", doubles="close")
def join_left(v: Views) -> DataFrame:
    prices = v["prices"].select(F.col("listing_id").alias("id"), "price_date", "close")
    return joins.left_join(v["companies"].select("id"), prices, "id")


@query(
    """SELECT coalesce(a.company_id, b.company_id) AS company_id, coalesce(a.fiscal_year, b.fiscal_year) AS fiscal_year,
           a.revenue, b.assets
    FROM (SELECT company_id, fiscal_year, max(value) AS revenue FROM {financial_facts} WHERE concept = 'Revenues' GROUP BY 1, 2) a
    FULL OUTER JOIN
         (SELECT company_id, fiscal_year, max(value) AS assets FROM {financial_facts} WHERE concept = 'Assets' GROUP BY 1, 2) b
      ON a.company_id = b.company_id AND a.fiscal_year = b.fiscal_year""",
    doubles="revenue assets",
)
def join_full_outer(v: Views) -> DataFrame:
    by = ["company_id", "fiscal_year"]
    facts = v["financial_facts"]
    revenue = facts.where("concept = 'Revenues'").groupBy(*by).agg(F.max("value").alias("revenue"))
    assets = facts.where("concept = 'Assets'").groupBy(*by).agg(F.max("value").alias("assets"))
    return joins.full_outer_coalesce(revenue, assets, by)


@query(
    f"""WITH {MAPPING} SELECT cn.field, ff.namespace, count(*) AS n FROM {{financial_facts}} ff JOIN cn ON {MATCH} GROUP BY 1, 2""",
    longs="n",
)
def join_wildcard(v: Views) -> DataFrame:
    """Rows per canonical field and taxonomy after the wildcard join."""
    mapped = joins.wildcard_join(v["financial_facts"], core.tag_mapping(v["financial_facts"]))
    return mapped.groupBy("field", "namespace").agg(F.count("*").alias("n"))


@query("SELECT l.id, l.ticker FROM {company_listings} l LEFT JOIN {prices} p ON p.listing_id = l.id WHERE p.listing_id IS NULL")
def join_anti(v: Views) -> DataFrame:
    return joins.anti(v["company_listings"], v["prices"].select(F.col("listing_id").alias("id")), "id").select("id", "ticker")


@query("SELECT id, ticker FROM {company_listings} WHERE id IN (SELECT listing_id FROM {prices})")
def join_semi(v: Views) -> DataFrame:
    return joins.semi(v["company_listings"], v["prices"].select(F.col("listing_id").alias("id")), "id").select("id", "ticker")


_YEARLY = """years AS (SELECT company_id, fiscal_year, max(value) AS revenue FROM {financial_facts}
      WHERE concept = 'Revenues' GROUP BY 1, 2)"""


def _yearly(v: Views) -> DataFrame:
    facts = v["financial_facts"].where("concept = 'Revenues'")
    return facts.groupBy("company_id", "fiscal_year").agg(F.max("value").alias("revenue"))


@query(
    f"""WITH {_YEARLY} SELECT a.*, b.revenue AS prev_revenue FROM years a
    LEFT JOIN years b ON b.company_id = a.company_id AND a.fiscal_year = b.fiscal_year + 1""",
    doubles="revenue prev_revenue",
)
def join_previous_year(v: Views) -> DataFrame:
    return joins.prev_year_join(_yearly(v), ["company_id"], "fiscal_year")


@query(
    """SELECT f.id, f.company_id, f.filing_date, m.start_date FROM {filings} f JOIN {membership} m
      ON m.company_id = f.company_id AND m.start_date <= f.filing_date AND (m.end_date IS NULL OR m.end_date > f.filing_date)"""
)
def join_interval(v: Views) -> DataFrame:
    """Filings with the membership interval they fall in, by company."""
    spans = v["membership"].select("company_id", "start_date", "end_date")
    points = v["filings"].select("id", "company_id", "filing_date")
    return joins.interval_join(points, spans, "filing_date", by=["company_id"]).drop("end_date")


@query(
    """SELECT c.id, count(DISTINCT f.id) AS filings, count(DISTINCT p.price_date) AS prices FROM {companies} c
    LEFT JOIN {filings} f ON f.company_id = c.id LEFT JOIN {prices} p ON p.listing_id = c.id GROUP BY 1""",
    longs="filings prices",
)
def join_count_branches(v: Views) -> DataFrame:
    branches = {
        "filings": v["filings"].select(F.col("company_id").alias("id")),
        "prices": v["prices"].select(F.col("listing_id").alias("id")),
    }
    return joins.count_branches(v["companies"].select("id"), branches, "id")


@query(
    """WITH wanted AS (SELECT DISTINCT identifier_value AS ticker FROM {company_identifiers}),
    ranked AS (SELECT DISTINCT ON (upper(ticker)) upper(ticker) AS ticker, company_id FROM {company_listings}
               ORDER BY upper(ticker), is_active DESC, is_primary DESC, listing_date DESC NULLS LAST, company_id)
    SELECT w.ticker, r.company_id FROM wanted w LEFT JOIN ranked r USING (ticker)"""
)
def ticker_resolution(v: Views) -> DataFrame:
    """Tickers with the company of their preferred listing; numbers stay unresolved."""
    wanted = v["company_identifiers"].select(F.col("identifier_value").alias("ticker")).distinct()
    return joins.resolve_tickers(wanted, v["company_listings"])


# --- aggregates ---------------------------------------------------------------


@query(
    """SELECT company_id, fiscal_year,
           coalesce(max(CASE WHEN concept IN ('Revenues', 'SalesRevenueNet') THEN value END), 0) AS revenue,
           max(CASE WHEN concept = 'AssetsCurrent' THEN value END) AS current_assets
    FROM {financial_facts} GROUP BY 1, 2""",
    doubles="revenue current_assets",
)
def agg_alias_pivot(v: Views) -> DataFrame:
    tags = {"revenue": ("Revenues", "SalesRevenueNet"), "current_assets": ("AssetsCurrent",)}
    return aggregates.alias_pivot(v["financial_facts"], ["company_id", "fiscal_year"], tags, {"revenue": 0})


@query(
    """SELECT fiscal_year, max(value) FILTER (WHERE unit = 'USD') AS top_usd,
           sum(value) FILTER (WHERE concept = 'OtherRevenue') AS other_sum,
           count(value) FILTER (WHERE fiscal_period = 'FY') AS yearly
    FROM {financial_facts} GROUP BY 1""",
    doubles="top_usd other_sum", longs="yearly",
)
def agg_filtered(v: Views) -> DataFrame:
    return aggregates.filtered_agg(
        v["financial_facts"], ["fiscal_year"],
        {
            "top_usd": ("max", "value", F.col("unit") == "USD"),
            "other_sum": ("sum", "value", F.col("concept") == "OtherRevenue"),
            "yearly": ("count", "value", F.col("fiscal_period") == "FY"),
        },
    )


@query(
    """SELECT concept, count(DISTINCT company_id) AS n_company_id, count(DISTINCT unit) AS n_unit
    FROM {financial_facts} GROUP BY 1""",
    longs="n_company_id n_unit",
)
def agg_distinct_counts(v: Views) -> DataFrame:
    return aggregates.distinct_counts(v["financial_facts"], ["concept"], ["company_id", "unit"])


@query(
    """SELECT count(*) FILTER (WHERE provider_id IS NULL) AS missing_provider_id,
           count(*) FILTER (WHERE filing_id IS NULL) AS missing_filing_id,
           count(*) FILTER (WHERE source_id IS NULL) AS missing_source_id
    FROM (SELECT provider_id, CASE WHEN fiscal_period = 'FY' THEN filing_id END AS filing_id,
                 nullif(source_id, '') AS source_id FROM {financial_facts}) f""",
    longs="missing_provider_id missing_filing_id missing_source_id",
)
def agg_provenance(v: Views) -> DataFrame:
    facts = v["financial_facts"].withColumn("filing_id", F.when(F.col("fiscal_period") == "FY", F.col("filing_id")))
    return aggregates.provenance_counters(facts)


@query("SELECT company_id, string_agg(DISTINCT form, ', ' ORDER BY form) AS form FROM {filings} GROUP BY 1")
def agg_distinct_list(v: Views) -> DataFrame:
    return aggregates.distinct_list(v["filings"], ["company_id"], "form")


@query("SELECT ticker, count(*) AS n FROM {company_listings} GROUP BY 1 HAVING count(*) >= 2", longs="n")
def agg_duplicates(v: Views) -> DataFrame:
    return aggregates.duplicates(v["company_listings"], ["ticker"])


@query(
    """SELECT company_id, min(fiscal_year) AS earliest_fiscal_year, max(fiscal_year) AS latest_fiscal_year,
           count(DISTINCT fiscal_year) AS distinct_fiscal_years, count(*) AS total_facts
    FROM {financial_facts} GROUP BY 1""",
    longs="distinct_fiscal_years total_facts",
)
def agg_coverage(v: Views) -> DataFrame:
    return aggregates.coverage(v["financial_facts"], ["company_id"])


@query("SELECT company_id, fiscal_year, min(value) AS value FROM {financial_facts} WHERE value < 0 GROUP BY 1, 2", doubles="value")
def agg_offending_min(v: Views) -> DataFrame:
    return aggregates.offending_min(v["financial_facts"].where("value < 0"), ["company_id", "fiscal_year"], "value")


@query(
    """WITH spans AS (SELECT company_id, form, filing_date, count(*) AS n FROM {filings} GROUP BY 1, 2, 3)
    SELECT s.* FROM spans s JOIN (SELECT company_id, form, max(filing_date) AS filing_date FROM spans GROUP BY 1, 2) l
    USING (company_id, form, filing_date)""",
    longs="n",
)
def agg_latest_period(v: Views) -> DataFrame:
    spans = v["filings"].groupBy("company_id", "form", "filing_date").agg(F.count("*").alias("n"))
    return aggregates.latest_period(spans, ["company_id", "form"], "filing_date")


@query(
    """SELECT unit, count(*) AS facts, count(DISTINCT company_id) AS companies FROM {financial_facts}
    WHERE regexp_matches(unit, '^[A-Z]{{3}}(/shares)?$') GROUP BY 1""",
    longs="facts companies",
)
def unit_distribution(v: Views) -> DataFrame:
    return aggregates.unit_distribution(v["financial_facts"])


_BACKFILL = f"""{CODES}, filled AS (
      SELECT company_id, source_id, value, unit,
             CASE WHEN currency IS NULL AND unit <> 'USD' AND unit IN (SELECT code FROM codes) THEN unit ELSE currency END
               AS currency FROM {{financial_facts}})"""


@query(f"WITH {_BACKFILL} SELECT * FROM filled", doubles="value")
def currency_backfill(v: Views) -> DataFrame:
    return writes.backfill_currency(v["financial_facts"]).select("company_id", "source_id", "value", "unit", "currency")


@query(
    f"""WITH {_BACKFILL} SELECT upper(l.ticker) AS ticker, f.currency, count(*) AS facts
    FROM filled f JOIN {{company_listings}} l ON l.company_id = f.company_id
    WHERE f.currency IS NOT NULL AND f.currency <> 'USD' GROUP BY 1, 2
    ORDER BY facts DESC, ticker, currency LIMIT 20""",
    longs="facts",
)
def top_non_usd(v: Views) -> DataFrame:
    return aggregates.top_non_usd(writes.backfill_currency(v["financial_facts"]), v["company_listings"], 20)


@query(
    f"""WITH {CODES}
    SELECT company_id, fiscal_year,
           coalesce(max(unit) FILTER (WHERE concept = 'Revenues' AND unit IN (SELECT code FROM codes)),
                    max(unit) FILTER (WHERE concept = 'Assets' AND unit IN (SELECT code FROM codes))) AS currency
    FROM {{financial_facts}} GROUP BY 1, 2"""
)
def row_currency(v: Views) -> DataFrame:
    unit, concept = F.col("unit"), F.col("concept")
    return v["financial_facts"].groupBy("company_id", "fiscal_year").agg(
        aggregates.row_currency(F.when(concept == "Revenues", unit), F.when(concept == "Assets", unit)).alias("currency")
    )


# --- windows ------------------------------------------------------------------


@query(
    f"""WITH {_YEARLY}, lagged AS (SELECT *, lag(revenue) OVER (PARTITION BY company_id ORDER BY fiscal_year) AS prev FROM years)
    SELECT company_id, fiscal_year, revenue,
           CASE WHEN prev <> 0 THEN (CAST(revenue AS DOUBLE) - CAST(prev AS DOUBLE)) / CAST(prev AS DOUBLE) * 100 END
             AS revenue_growth_pct FROM lagged""",
    doubles="revenue revenue_growth_pct",
)
def window_growth_available(v: Views) -> DataFrame:
    """Growth against the previous year on record, gaps bridged."""
    return windows.growth_lag(_yearly(v), ["company_id"], "fiscal_year", ["revenue"])


@query(
    f"""WITH {_YEARLY}
    SELECT a.company_id, a.fiscal_year, a.revenue,
           CASE WHEN b.revenue <> 0 THEN (CAST(a.revenue AS DOUBLE) - CAST(b.revenue AS DOUBLE)) / CAST(b.revenue AS DOUBLE) * 100
           END AS revenue_growth_pct
    FROM years a LEFT JOIN years b ON b.company_id = a.company_id AND b.fiscal_year = a.fiscal_year - 1""",
    doubles="revenue revenue_growth_pct",
)
def window_growth_exact(v: Views) -> DataFrame:
    """Growth against exactly the year before, NULL after a gap."""
    return windows.growth_exact(_yearly(v), ["company_id"], "fiscal_year", ["revenue"])


@query(
    """SELECT DISTINCT ON (upper(ticker)) upper(ticker) AS ticker, id, is_active, is_primary FROM {company_listings}
    ORDER BY upper(ticker), is_active DESC, is_primary DESC, listing_date DESC NULLS LAST, id"""
)
def window_preferred(v: Views) -> DataFrame:
    rows = v["company_listings"].withColumn("ticker", F.upper("ticker"))
    order = [F.desc("is_active"), F.desc("is_primary"), F.col("listing_date").desc_nulls_last(), F.asc("id")]
    return windows.preferred(rows, ["ticker"], order).select("ticker", "id", "is_active", "is_primary")


_COPIES = """copies AS (
      SELECT company_id, concept, period_start, period_end, CASE WHEN fiscal_period = 'FY' THEN filing_id END AS filing_id,
             filing_date, source_id, value FROM {financial_facts})"""
_COPY_KEY = ["company_id", "concept", "period_start", "period_end", "filing_id"]


def _copies(v: Views) -> DataFrame:
    facts = v["financial_facts"]
    return facts.withColumn("filing_id", F.when(F.col("fiscal_period") == "FY", F.col("filing_id"))).select(
        *_COPY_KEY, "filing_date", "source_id", "value"
    )


@query(
    f"""WITH {_COPIES} SELECT * EXCLUDE rn FROM (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(_COPY_KEY)} ORDER BY filing_date, source_id, value) AS rn
      FROM copies) r WHERE rn = 1""",
    doubles="value",
)
def dedup_keep_first(v: Views) -> DataFrame:
    """First row per natural key; missing filing and start compare equal."""
    return windows.keep_first(_copies(v), _COPY_KEY, ["filing_date", "source_id", "value"])


@query(
    f"""WITH {_YEARLY} SELECT company_id, fiscal_year, revenue FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY fiscal_year DESC) AS rn FROM years) r WHERE rn = 1""",
    doubles="revenue",
)
def window_latest_year(v: Views) -> DataFrame:
    return windows.latest_year(_yearly(v), ["company_id"])


@query(
    """SELECT company_id, id, form, filing_date FROM (
      SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY filing_date DESC, id DESC) AS rn FROM {filings}) r
    WHERE rn = 1"""
)
def window_latest_row(v: Views) -> DataFrame:
    return windows.latest_by(v["filings"], ["company_id"], ["filing_date", "id"]).select(
        "company_id", "id", "form", "filing_date"
    )


# --- order and paging ---------------------------------------------------------


@query("SELECT id, last_synced_at IS NULL AS never, sector FROM {companies} ORDER BY last_synced_at DESC NULLS LAST, id")
def order_nulls_last(v: Views) -> DataFrame:
    return paging.order_nulls_last(v["companies"], "last_synced_at", "id").select(
        "id", F.col("last_synced_at").isNull().alias("never"), "sector"
    )


@query("SELECT id, filing_date FROM {filings} ORDER BY filing_date DESC, id LIMIT 25")
def top_n(v: Views) -> DataFrame:
    return paging.top_n(v["filings"].select("id", "filing_date"), [F.desc("filing_date"), "id"], 25)


@query("SELECT id, ticker FROM {company_listings} ORDER BY ticker, id LIMIT 50 OFFSET 100")
def page(v: Views) -> DataFrame:
    return paging.page(v["company_listings"].select("id", "ticker"), ["ticker", "id"], 50, 100)


@query(
    """WITH base AS (SELECT id, exchange_id, ticker, is_primary, is_active FROM {company_listings}),
    large AS (SELECT id FROM base WHERE ticker LIKE 'M1%'),
    small AS (SELECT id FROM base WHERE exchange_id IN ('NYSE', 'NASDAQ') AND NOT ticker LIKE 'M1%' ORDER BY id LIMIT 50),
    foreign_ AS (SELECT id FROM base WHERE exchange_id NOT IN ('NYSE', 'NASDAQ') ORDER BY id LIMIT 30),
    none AS (SELECT id FROM base WHERE NOT is_active ORDER BY id LIMIT 20),
    picked AS (SELECT id, min(s) AS s FROM (SELECT id, 0 AS s FROM large UNION ALL SELECT id, 1 FROM small
               UNION ALL SELECT id, 2 FROM foreign_ UNION ALL SELECT id, 3 FROM none) u GROUP BY id),
    rest AS (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM base WHERE id NOT IN (SELECT id FROM picked))
    SELECT id, CASE s WHEN 0 THEN 'large' WHEN 1 THEN 'small' WHEN 2 THEN 'foreign' ELSE 'inactive' END AS stratum FROM picked
    UNION ALL SELECT id, 'fill' FROM rest WHERE rn <= greatest(750 - (SELECT count(*) FROM picked), 0)"""
)
def stratified_pick(v: Views) -> DataFrame:
    """A repeatable sample: first keys per stratum, filled up by key."""
    us = F.col("exchange_id").isin("NYSE", "NASDAQ")
    large = F.col("ticker").startswith("M1")
    strata = {
        "large": (large, None),
        "small": (us & ~large, 50),
        "foreign": (~us, 30),
        "inactive": (~F.col("is_active"), 20),
    }
    return paging.stratified_pick(v["company_listings"], "id", strata, 750)


# --- writes (their DataFrame part) ---------------------------------------------


def _target(v: Views) -> DataFrame:
    return _copies(v).where("period_end <= DATE '1998-12-31'")


@query(
    f"""WITH {_COPIES}, firsts AS (SELECT * EXCLUDE rn FROM (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(_COPY_KEY)} ORDER BY filing_date, source_id, value) AS rn
      FROM copies) r WHERE rn = 1)
    SELECT f.* FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM copies t WHERE t.period_end <= DATE '1998-12-31' AND
      {" AND ".join(f"t.{k} IS NOT DISTINCT FROM f.{k}" for k in _COPY_KEY)})""",
    doubles="value",
)
def insert_new_result(v: Views) -> DataFrame:
    """Insert-if-absent of all facts into a table that holds the earlier years."""
    return writes.insert_rows(_target(v), _copies(v), _COPY_KEY, ["filing_date"])


@query(
    f"""WITH {_COPIES}, firsts AS (SELECT {", ".join(_COPY_KEY)}, count(*) AS n FROM copies GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS processed,
           count(*) FILTER (WHERE NOT seen) AS inserted, CAST(sum(n) AS BIGINT) - count(*) FILTER (WHERE NOT seen) AS skipped
    FROM (SELECT f.n, EXISTS (SELECT 1 FROM copies t WHERE t.period_end <= DATE '1998-12-31' AND
      {" AND ".join(f"t.{k} IS NOT DISTINCT FROM f.{k}" for k in _COPY_KEY)}) AS seen FROM firsts f) x""",
    longs="processed inserted skipped",
)
def insert_counters(v: Views) -> DataFrame:
    """The counters of the same insert: processed, inserted, skipped."""
    flagged = writes.flag_existing(writes.first_per_key(_copies(v), _COPY_KEY), _target(v), _COPY_KEY)
    new = F.count_if(~F.col("_exists"))
    return flagged.agg(
        F.sum("_copies").alias("processed"), new.alias("inserted"), (F.sum("_copies") - new).alias("skipped")
    )


_RATES = """current_rates AS (SELECT currency, rate_date, usd_per_unit, 'old' AS source FROM {fx_rates}
      WHERE rate_date < DATE '1999-01-01'),
    news AS (SELECT currency, rate_date, max(usd_per_eur) AS usd_per_unit, 'new' AS source
             FROM (SELECT currency, rate_date, CAST(per_eur AS DECIMAL(24,10)) AS usd_per_eur FROM {per_eur}
                   WHERE currency = 'GBP') x GROUP BY 1, 2)"""


def _rates(v: Views) -> tuple[DataFrame, DataFrame]:
    old = v["fx_rates"].where("rate_date < DATE '1999-01-01'").withColumn("source", F.lit("old"))
    new = v["per_eur"].where("currency = 'GBP'").select(
        "currency", "rate_date", F.col("per_eur").cast("decimal(24,10)").alias("usd_per_unit"), F.lit("new").alias("source")
    )
    return old, new


@query(
    f"""WITH {_RATES} SELECT * FROM news UNION ALL
    SELECT * FROM current_rates c WHERE NOT EXISTS (
      SELECT 1 FROM news n WHERE n.currency = c.currency AND n.rate_date = c.rate_date)""",
    doubles="usd_per_unit",
)
def upsert_result(v: Views) -> DataFrame:
    old, new = _rates(v)
    return writes.upsert_rows(old, new, ["currency", "rate_date"], "usd_per_unit")


@query(
    f"""WITH {_RATES} SELECT * FROM current_rates WHERE currency IS DISTINCT FROM 'GBP' UNION ALL SELECT * FROM news""",
    doubles="usd_per_unit",
)
def replace_where_result(v: Views) -> DataFrame:
    old, new = _rates(v)
    return writes.replace_rows(old, F.col("currency") == "GBP", new)


@query(
    """SELECT c.id, c.legal_name, coalesce(n.sector, c.sector) AS sector, coalesce(n.industry, c.industry) AS industry
    FROM {companies} c LEFT JOIN (
      SELECT company_id, CASE WHEN max(is_primary) THEN NULL ELSE 'sector of ' || max(ticker) END AS sector,
             max(exchange_id) AS industry FROM {company_listings} WHERE is_active GROUP BY 1) n ON n.company_id = c.id"""
)
def patch_result(v: Views) -> DataFrame:
    """Companies patched from listings: NULLs in the patch clear nothing."""
    news = v["company_listings"].where("is_active").groupBy(F.col("company_id").alias("id")).agg(
        F.when(~F.max("is_primary"), F.concat(F.lit("sector of "), F.max("ticker"))).alias("sector"),
        F.max("exchange_id").alias("industry"),
    )
    companies = v["companies"].select("id", "legal_name", "sector", "industry")
    return writes.patch_rows(companies, news, ["id"], ["sector", "industry"])


@query(
    """SELECT id, source_identifier, is_processed OR id IN (SELECT doc_id FROM {labels} WHERE quality = 1) AS is_processed
    FROM {raw_documents}"""
)
def mark_processed(v: Views) -> DataFrame:
    done = v["labels"].where("quality = 1").select(F.col("doc_id").alias("id"))
    return writes.mark(v["raw_documents"], done, "id", "is_processed").select("id", "source_identifier", "is_processed")


# --- row normalization ----------------------------------------------------------


@query(
    f"""WITH {CODES}
    SELECT c_custkey AS id, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
           replace(lpad(CAST(c_custkey AS VARCHAR), 10, '0') || '-23-000106', '-', '') AS accession,
           replace(upper(c_mktsegment || '.b'), '.', '-') AS ticker,
           CASE c_nationkey % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'FOREIGN' ELSE 'USA' END AS country,
           CASE WHEN c_mktsegment IN ('BUILDING') THEN 'EUR' WHEN c_mktsegment = 'MACHINERY' THEN 'GBP' END AS currency
    FROM {{customer}}"""
)
def normalize_keys(v: Views) -> DataFrame:
    """Company numbers, accession numbers, tickers, countries and currencies from untidy text."""
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    exchange = F.element_at(
        F.array(F.lit(" "), F.lit("Euronext"), F.lit(" nasdaq "), F.lit("Nyse American")),
        (F.col("c_nationkey") % 4 + 1).cast("int"),
    )
    unit = F.when(segment == "BUILDING", " eur").when(segment == "MACHINERY", "GBP/shares").otherwise(F.lower(segment))
    return v["customer"].select(
        F.col("c_custkey").alias("id"),
        keys.cik(F.concat(F.lit(" 000"), key, F.lit(" "))).alias("cik"),
        keys.accession(F.concat(F.lit(" "), F.lpad(key, 10, "0"), F.lit("-23-000106 "))).alias("accession"),
        keys.ticker(F.concat(F.lit(' "'), F.lower(segment), F.lit('.b" '))).alias("ticker"),
        keys.country(exchange).alias("country"),
        money.currency_from_unit(unit).alias("currency"),
    )


_SUFFIX = "CASE exchange_id WHEN 'OTC' THEN 'otc' WHEN 'PINK' THEN 'pink' ELSE 'us' END"


@query(
    f"""SELECT id, CASE WHEN exchange_id IN ({", ".join(f"'{x}'" for x in constants.US_QUOTE_EXCHANGES)}) THEN upper(ticker) END AS quote_symbol,
           lower(ticker) || '.' || {_SUFFIX} AS csv_symbol FROM {{company_listings}}"""
)
def quote_symbols(v: Views) -> DataFrame:
    tick, code = F.col("ticker"), F.col("exchange_id")
    return v["company_listings"].select(
        "id", keys.quote_symbol(tick, code).alias("quote_symbol"), keys.quote_symbol(tick, code, "csv").alias("csv_symbol")
    )
