"""Integrity, ticker health, constraints, freshness and run bookkeeping.

The given tables are clean, so the faults to be found are made from them: copies,
rows moved to an unknown parent, blanked references.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.plans import audit, runs
from periodica.workload.registry import query
from periodica.workload.views import Views

# --- tables with faults ---------------------------------------------------------

_BAD = {
    # Inactive companies appear twice, the second time without anything attached.
    "companies": """SELECT id, legal_name, country, is_active FROM {companies}
      UNION ALL SELECT -1 - id, legal_name, country, false FROM {companies} WHERE NOT is_active""",
    # Inactive companies also carry their neighbour's number; idle furniture makers carry none.
    "company_identifiers": """SELECT i.company_id, i.identifier_type, i.identifier_value FROM {company_identifiers} i
        JOIN {companies} c ON c.id = i.company_id WHERE c.is_active OR c.sector IS DISTINCT FROM 'FURNITURE'
      UNION ALL SELECT id, 'CIK', lpad(CAST(id + 1 AS STRING), 10, '0') FROM {companies}
        WHERE NOT is_active AND sector IS DISTINCT FROM 'FURNITURE'
      UNION ALL SELECT id, 'CIK', lpad(CAST(id AS STRING), 10, '0') FROM {companies}
        WHERE NOT is_active AND sector = 'BUILDING'""",
    # Active listings of furniture makers are repeated, some on an exchange nobody knows.
    "company_listings": """SELECT id, company_id, exchange_id, ticker, is_active FROM {company_listings}
      UNION ALL SELECT -1 - l.id, l.company_id, CASE WHEN l.is_primary THEN l.exchange_id ELSE 'NOWHERE' END, l.ticker, true
        FROM {company_listings} l JOIN {companies} c ON c.id = l.company_id
        WHERE l.is_active AND c.sector = 'FURNITURE'""",
    # Urgent filings of finished orders were filed again for an unknown company.
    "filings": """SELECT id, company_id, provider_id, accession_number, form FROM {filings}
      UNION ALL SELECT -1 - o_orderkey, -1 - o_custkey, f.provider_id, f.accession_number, f.form
        FROM {orders} o JOIN {filings} f ON f.id = o.o_orderkey
        WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT'""",
    # Capital spending is repeated, shares lose company and filing, cash its value and source.
    "financial_facts": """SELECT CASE WHEN concept = 'CommonStockSharesOutstanding' THEN -1 - company_id ELSE company_id END AS company_id,
             concept, period_start, period_end,
             CASE WHEN concept = 'CommonStockSharesOutstanding' THEN -1 - filing_id
                  WHEN concept = 'GrossProfit' THEN NULL ELSE filing_id END AS filing_id,
             nullif(provider_id, '') AS provider_id,
             CASE WHEN concept <> 'CashAndCashEquivalents' THEN source_id END AS source_id,
             CASE WHEN concept <> 'CashAndCashEquivalents' THEN value END AS value
        FROM {financial_facts}
      UNION ALL SELECT company_id, concept, period_start, period_end, filing_id, provider_id, source_id, value
        FROM {financial_facts} WHERE concept = 'PaymentsToAcquirePropertyPlantAndEquipment'""",
}
_BAD_SQL = ",\n".join(f"bad_{name} AS ({text})" for name, text in _BAD.items())


class Faulty(Mapping[str, DataFrame]):
    """The views with the faulty tables in place of the clean ones."""

    def __init__(self, views: Views) -> None:
        self.views = views

    def __getitem__(self, name: str) -> DataFrame:
        if name not in _BAD:
            return self.views[name]
        from periodica.workload.views import references

        text = _BAD[name]
        return self.views.spark.sql(text, **{n: self.views[n] for n in references(text)})

    def __iter__(self):
        return iter(self.views)

    def __len__(self) -> int:
        return len(self.views)


_FACT_KEY = "company_id, concept, period_start, period_end, filing_id, source_id"


def _groups(table: str, key: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM (SELECT {key} FROM bad_{table} WHERE {where} GROUP BY {key} HAVING count(*) > 1) g)"


def _orphans(table: str, parent: str, fk: str, where: str = "true") -> str:
    return (
        f"(SELECT count(*) FROM bad_{table} x LEFT JOIN bad_{parent} y ON y.id = x.{fk} WHERE y.id IS NULL AND {where})"
    )


def _childless(child: str) -> str:
    return (
        f"(SELECT count(*) FROM bad_companies c LEFT JOIN (SELECT DISTINCT company_id FROM bad_{child}) x "
        "ON x.company_id = c.id WHERE x.company_id IS NULL)"
    )


_CHECKS = {
    "dup_companies": ("error", _groups("companies", "legal_name, country")),
    "shared_cik": (
        "error",
        "(SELECT count(*) FROM (SELECT identifier_value FROM bad_company_identifiers WHERE identifier_type = 'CIK' "
        "GROUP BY 1 HAVING count(DISTINCT company_id) > 1) g)",
    ),
    "dup_identifiers": ("error", _groups("company_identifiers", "company_id, identifier_type, identifier_value")),
    "dup_listings": ("error", _groups("company_listings", "company_id, exchange_id, ticker", "is_active")),
    "dup_filings": ("error", _groups("filings", "provider_id, accession_number")),
    "dup_facts": ("error", _groups("financial_facts", _FACT_KEY)),
    "orphan_facts": ("error", _orphans("financial_facts", "companies", "company_id")),
    "companies_without_facts": ("info", _childless("financial_facts")),
    "orphan_filings": ("error", _orphans("filings", "companies", "company_id")),
    "companies_without_filings": ("info", _childless("filings")),
    "orphan_listings": (
        "error",
        "(SELECT count(*) FROM bad_company_listings l LEFT JOIN bad_companies c ON c.id = l.company_id "
        "LEFT JOIN {exchanges} e ON e.id = l.exchange_id WHERE c.id IS NULL OR e.id IS NULL)",
    ),
    "companies_without_identifiers": ("error", _childless("company_identifiers")),
    "null_values": ("error", "(SELECT count(*) FROM bad_financial_facts WHERE value IS NULL)"),
    "missing_provider_id": ("error", "(SELECT count(*) FROM bad_financial_facts WHERE provider_id IS NULL)"),
    "missing_filing_id": ("error", "(SELECT count(*) FROM bad_financial_facts WHERE filing_id IS NULL)"),
    "missing_source_id": ("error", "(SELECT count(*) FROM bad_financial_facts WHERE source_id IS NULL)"),
    "dangling_filings": ("error", _orphans("financial_facts", "filings", "filing_id", "x.filing_id IS NOT NULL")),
}


@query(
    f"WITH {_BAD_SQL} "
    + " UNION ALL ".join(f"SELECT '{k}' AS check, '{s}' AS severity, {n} AS n" for k, (s, n) in _CHECKS.items()),
    longs="n",
)
def integrity_audit(v: Views) -> DataFrame:
    """Counts of every integrity check over tables with faults."""
    return audit.integrity_audit(Faulty(v))


@query(f"WITH {_BAD_SQL} SELECT legal_name, country, count(*) AS n FROM bad_companies GROUP BY 1, 2 HAVING count(*) > 1", longs="n")
def dup_companies(v: Views) -> DataFrame:
    return audit.dup_companies(Faulty(v)["companies"])


@query(
    f"""WITH {_BAD_SQL} SELECT identifier_value AS cik, count(DISTINCT company_id) AS n_companies FROM bad_company_identifiers
    WHERE identifier_type = 'CIK' GROUP BY 1 HAVING count(DISTINCT company_id) > 1""",
    longs="n_companies",
)
def shared_cik(v: Views) -> DataFrame:
    return audit.shared_cik(Faulty(v)["company_identifiers"])


@query(
    f"""WITH {_BAD_SQL} SELECT company_id, identifier_type, identifier_value, count(*) AS n FROM bad_company_identifiers
    GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    longs="n",
)
def dup_identifiers(v: Views) -> DataFrame:
    return audit.dup_identifiers(Faulty(v)["company_identifiers"])


@query(
    f"""WITH {_BAD_SQL} SELECT company_id, exchange_id, ticker, count(*) AS n FROM bad_company_listings
    WHERE is_active GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    longs="n",
)
def dup_listings(v: Views) -> DataFrame:
    return audit.dup_listings(Faulty(v)["company_listings"])


@query(
    f"""WITH {_BAD_SQL} SELECT provider_id, accession_number, count(*) AS n FROM bad_filings
    GROUP BY 1, 2 HAVING count(*) > 1""",
    longs="n",
)
def dup_filings(v: Views) -> DataFrame:
    return audit.dup_filings(Faulty(v)["filings"])


@query(f"WITH {_BAD_SQL} SELECT {_FACT_KEY}, count(*) AS n FROM bad_financial_facts GROUP BY ALL HAVING count(*) > 1", longs="n")
def dup_facts(v: Views) -> DataFrame:
    return audit.dup_facts(Faulty(v)["financial_facts"])


@query(
    f"""WITH {_BAD_SQL} SELECT x.company_id, x.concept, x.source_id FROM bad_financial_facts x
    LEFT JOIN bad_companies c ON c.id = x.company_id WHERE c.id IS NULL"""
)
def orphan_facts(v: Views) -> DataFrame:
    t = Faulty(v)
    return audit.orphans(t["financial_facts"], t["companies"], "company_id").select("company_id", "concept", "source_id")


@query(
    f"""WITH {_BAD_SQL} SELECT l.id, l.company_id, l.exchange_id FROM bad_company_listings l
    WHERE l.company_id NOT IN (SELECT id FROM bad_companies) OR l.exchange_id NOT IN (SELECT id FROM {{exchanges}})"""
)
def orphan_listings(v: Views) -> DataFrame:
    t = Faulty(v)
    return audit.orphan_listings(t["company_listings"], t["companies"], t["exchanges"]).select(
        "id", "company_id", "exchange_id"
    )


@query(f"WITH {_BAD_SQL} SELECT concept, count(*) AS n FROM bad_financial_facts WHERE value IS NULL GROUP BY 1", longs="n")
def null_values(v: Views) -> DataFrame:
    return audit.null_values(Faulty(v)["financial_facts"]).groupBy("concept").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_BAD_SQL} SELECT id, legal_name FROM bad_companies
    WHERE id NOT IN (SELECT company_id FROM bad_company_identifiers)"""
)
def companies_without_identifiers(v: Views) -> DataFrame:
    t = Faulty(v)
    return audit.childless(t["companies"], t["company_identifiers"]).select("id", "legal_name")


@query(
    f"""WITH {_BAD_SQL} SELECT count(*) FILTER (WHERE provider_id IS NULL) AS missing_provider_id,
           count(*) FILTER (WHERE filing_id IS NULL) AS missing_filing_id,
           count(*) FILTER (WHERE source_id IS NULL) AS missing_source_id,
           {_CHECKS["dangling_filings"][1]} AS dangling_filing_id
    FROM bad_financial_facts""",
    longs="missing_provider_id missing_filing_id missing_source_id dangling_filing_id",
)
def provenance_gaps(v: Views) -> DataFrame:
    t = Faulty(v)
    return audit.provenance_gaps(t["financial_facts"], t["filings"])


# --- ticker health --------------------------------------------------------------

_CORE_FORMS = "('10-K', '10-K/A', '10-Q', '10-Q/A', '20-F', '20-F/A', '40-F', '40-F/A')"


@query(
    f"""WITH prefixes AS (
      SELECT f.company_id, left(f.accession_number, 10) AS prefix, count(*) AS facts
      FROM {{filings}} f JOIN {{financial_facts}} ff ON ff.filing_id = f.id WHERE f.form IN {_CORE_FORMS} GROUP BY 1, 2),
    marked AS (SELECT *, count(*) OVER (PARTITION BY prefix) > 3 AS by_agent FROM prefixes)
    SELECT c.legal_name, i.identifier_value AS company_cik, l.ticker, sum(m.facts) AS n_core_facts,
           string_agg(m.prefix, ', ' ORDER BY m.prefix) AS filing_prefixes
    FROM marked m JOIN {{companies}} c ON c.id = m.company_id JOIN {{company_listings}} l USING (company_id)
    JOIN {{company_identifiers}} i USING (company_id)
    WHERE l.is_active AND i.identifier_type = 'CIK' GROUP BY 1, 2, 3
    HAVING NOT bool_or(m.by_agent) AND NOT bool_or(m.prefix = i.identifier_value)""",
    longs="n_core_facts",
)
def stub_companies(v: Views) -> DataFrame:
    return audit.stub_companies(v)


@query(
    """WITH pairs AS (SELECT l.ticker, i.identifier_value AS cik, c.legal_name FROM {company_listings} l
      JOIN {companies} c ON c.id = l.company_id JOIN {company_identifiers} i ON i.company_id = c.id
      WHERE l.is_active AND i.identifier_type = 'CIK')
    SELECT ticker, len(list_distinct(list(cik))) AS n_ciks,
           array_to_string(list_sort(list_distinct(list(cik))), ', ') AS ciks,
           array_to_string(list_sort(list_distinct(list(legal_name))), ' | ') AS companies
    FROM pairs GROUP BY 1 HAVING min(cik) <> max(cik)""",
    longs="n_ciks",
)
def multi_cik_tickers(v: Views) -> DataFrame:
    return audit.multi_cik_tickers(v)


# Every company once more as a listed shell that has no facts; those of one country have a number.
_SHELLS = 10**12


def with_shells(v: Views) -> dict[str, DataFrame]:
    """The tables of the check with a shell beside every company. All facts stay."""
    c = F.col
    companies, listings, numbers = (v[n] for n in ("companies", "company_listings", "company_identifiers"))
    abroad = companies.where("country = 'NATION_3'").select(c("id").alias("company_id"))
    return {
        "companies": companies.unionByName(
            companies.withColumns({"id": c("id") + _SHELLS, "legal_name": F.concat("legal_name", F.lit(" shell"))})),
        "company_listings": listings.unionByName(
            listings.withColumns({"company_id": c("company_id") + _SHELLS, "ticker": F.concat(F.lit("SHELL "), "ticker")})),
        "company_identifiers": numbers.unionByName(
            numbers.join(abroad, "company_id", "left_semi").withColumn("company_id", c("company_id") + _SHELLS)),
        "financial_facts": v["financial_facts"],
    }


@query(
    f"""WITH all_companies AS (SELECT id, legal_name FROM {{companies}} UNION ALL SELECT id + {_SHELLS}, legal_name || ' shell' FROM {{companies}}),
    all_listings AS (SELECT company_id, ticker FROM {{company_listings}} WHERE is_active
      UNION ALL SELECT company_id + {_SHELLS}, 'SHELL ' || ticker FROM {{company_listings}} WHERE is_active),
    numbers AS (SELECT company_id, identifier_value FROM {{company_identifiers}} WHERE identifier_type = 'CIK'),
    all_numbers AS (SELECT * FROM numbers UNION ALL SELECT company_id + {_SHELLS}, identifier_value FROM numbers
      WHERE company_id IN (SELECT id FROM {{companies}} WHERE country = 'NATION_3'))
    SELECT l.ticker, c.legal_name, i.identifier_value AS cik FROM all_listings l JOIN all_companies c ON c.id = l.company_id
    LEFT JOIN all_numbers i ON i.company_id = c.id
    WHERE l.company_id NOT IN (SELECT company_id FROM {{financial_facts}})"""
)
def tickers_without_facts(v: Views) -> DataFrame:
    """Active tickers without any fact, among them a shell of every company."""
    return audit.tickers_without_facts(with_shells(v))


@query(
    f"""WITH {_BAD_SQL}, wanted AS (SELECT lower(ticker) AS ticker FROM {{company_listings}} UNION SELECT c_mktsegment FROM {{customer}})
    SELECT w.ticker, CASE WHEN k.tick IS NULL THEN 'no company_listings row' ELSE 'no CIK identifier' END AS failure
    FROM wanted w LEFT JOIN (
      SELECT upper(l.ticker) AS tick, bool_or(i.company_id IS NOT NULL) AS numbered FROM bad_company_listings l
      LEFT JOIN (SELECT DISTINCT company_id FROM bad_company_identifiers WHERE identifier_type = 'CIK') i USING (company_id)
      GROUP BY 1) k ON k.tick = upper(w.ticker)
    WHERE NOT coalesce(k.numbered, false)"""
)
def unresolved_universe(v: Views) -> DataFrame:
    wanted = v["company_listings"].select(F.lower("ticker").alias("ticker")).union(
        v["customer"].select("c_mktsegment")
    ).distinct()
    return audit.unresolved_universe(wanted, Faulty(v))


@query(
    """WITH targets AS (SELECT 'Target ' || o_orderpriority || ' ' || CAST(o_custkey AS VARCHAR) AS company_name,
           lpad(CAST(o_custkey + CASE WHEN o_orderpriority = '5-LOW' THEN 100000000 ELSE 0 END AS VARCHAR), 10, '0') AS cik
      FROM {orders} GROUP BY o_orderpriority, o_custkey)
    SELECT t.company_name, t.cik, min(f.fiscal_year) AS earliest_fiscal_year, max(f.fiscal_year) AS latest_fiscal_year,
           count(DISTINCT f.fiscal_year) AS distinct_fiscal_years, count(f.company_id) AS total_facts
    FROM targets t LEFT JOIN {company_identifiers} i ON i.identifier_type = 'CIK' AND i.identifier_value = t.cik
    LEFT JOIN {financial_facts} f ON f.company_id = i.company_id GROUP BY 1, 2""",
    longs="distinct_fiscal_years total_facts",
)
def history_coverage(v: Views) -> DataFrame:
    """Covered years of wanted companies, unknown ones included."""
    number = F.col("o_custkey") + F.when(F.col("o_orderpriority") == "5-LOW", 100000000).otherwise(0)
    targets = v["orders"].select(
        F.concat(F.lit("Target "), "o_orderpriority", F.lit(" "), F.col("o_custkey").cast("string")).alias("company_name"),
        F.lpad(number.cast("string"), 10, "0").alias("cik"),
    ).distinct()
    return audit.history_coverage(v, targets)


# --- constraints ----------------------------------------------------------------

_SPANS = """spans AS (SELECT o_orderkey AS id, o_custkey AS company_id, o_orderpriority AS exchange_id,
             nullif(o_orderstatus, 'P') AS share_class, CAST(o_orderdate AS DATE) AS listing_date,
             CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS delisting_date FROM {orders})"""


def _spans(v: Views) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return v["orders"].select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company_id"), F.col("o_orderpriority").alias("exchange_id"),
        F.nullif("o_orderstatus", F.lit("P")).alias("share_class"), day.alias("listing_date"),
        F.date_add(day, (F.col("o_orderkey") % 400).cast("int")).alias("delisting_date"),
    )


_OVERLAPS = """(SELECT count(*) FROM spans a WHERE a.share_class IS NOT NULL AND EXISTS (
      SELECT 1 FROM spans b WHERE b.company_id = a.company_id AND b.exchange_id = a.exchange_id
        AND b.share_class = a.share_class AND b.delisting_date >= a.listing_date
        AND (b.listing_date, b.id) < (a.listing_date, a.id)))"""


@query(
    f"""WITH {_SPANS}, touching AS (SELECT a.* FROM spans a WHERE a.share_class IS NOT NULL AND EXISTS (
      SELECT 1 FROM spans b WHERE b.company_id = a.company_id AND b.exchange_id = a.exchange_id
        AND b.share_class = a.share_class AND b.delisting_date >= a.listing_date
        AND (b.listing_date, b.id) < (a.listing_date, a.id)))
    SELECT company_id, exchange_id, share_class, listing_date, count(*) AS n FROM touching GROUP BY ALL""",
    longs="n",
)
def overlapping_listings(v: Views) -> DataFrame:
    return audit.overlapping_listings(_spans(v))


_BROKEN = {
    "filing_period": "(SELECT count(*) FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate)",
    "fact_period": "(SELECT count(*) FROM {financial_facts} WHERE period_end < filing_date)",
    "dividend_amount": "(SELECT count(*) FROM {dividends} WHERE amount < 0)",
    "dividend_dates": "(SELECT count(*) FROM {dividends} WHERE ex_date > record_date)",
    "split_terms": "(SELECT count(*) FROM {splits} WHERE numerator <= 0 OR denominator <= 0)",
    "run_status": "(SELECT count(*) FROM {events} WHERE event_type NOT IN ('running', 'success', 'failed', 'partial'))",
    "fx_rate_positive": "(SELECT count(*) FROM {per_eur} WHERE per_eur <= 0)",
    "membership_interval": "(SELECT count(*) FROM spans WHERE delisting_date <= listing_date)",
    "overlapping_listings": _OVERLAPS,
}


@query(
    f"WITH {_SPANS} " + " UNION ALL ".join(f"SELECT '{k}' AS check, 'error' AS severity, {n} AS n" for k, n in _BROKEN.items()),
    longs="n",
)
def constraint_audit(v: Views) -> DataFrame:
    """Broken row constraints, over tables in which some are."""
    spans = _spans(v)
    shipped = v["lineitem"].join(v["orders"], v["lineitem"]["l_orderkey"] == v["orders"]["o_orderkey"])
    return audit.constraint_violations(
        {
            "filings": shipped.select(F.col("o_orderdate").alias("period_start"), F.col("l_shipdate").alias("period_end")),
            "financial_facts": v["financial_facts"].select(F.col("filing_date").alias("period_start"), "period_end"),
            "dividends": v["dividends"],
            "splits": v["splits"],
            "import_runs": v["events"].select(F.col("event_type").alias("status")),
            "fx_rates": v["per_eur"].select(F.col("per_eur").alias("usd_per_unit")),
            "index_constituents": spans.select(
                F.col("listing_date").alias("start_date"), F.col("delisting_date").alias("end_date")
            ),
            "company_listings": spans,
        }
    )


# --- freshness and runs -----------------------------------------------------------


@query(
    """WITH seen AS (
      SELECT c.id AS company_id, c.legal_name,
             greatest((SELECT max(created_at) FROM {financial_facts} f WHERE f.company_id = c.id),
                      (SELECT max(created_at) FROM {filings} f WHERE f.company_id = c.id), c.updated_at) AS fresh_at
      FROM {companies} c)
    SELECT company_id, legal_name FROM seen
    WHERE fresh_at IS NULL OR fresh_at < TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 2400 HOUR"""
)
def stale_companies(v: Views) -> DataFrame:
    """Companies whose facts, filings and own row all are older than a hundred days."""
    return audit.stale_companies(v, "2001-06-01", 2400).select("company_id", "legal_name")


@query(
    """SELECT 'stale_companies' AS check, 'warning' AS severity, count(*) AS n FROM {companies}
      WHERE last_synced_at IS NULL OR last_synced_at < TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 48 HOUR
    UNION ALL SELECT 'listings_without_prices', 'warning', count(*) FROM {company_listings}
      WHERE is_active AND id NOT IN (SELECT listing_id FROM {prices})
    UNION ALL SELECT 'runs_open', 'info', count(*) FROM {import_runs} WHERE status = 'running'""",
    longs="n",
)
def freshness_report(v: Views) -> DataFrame:
    return audit.freshness_report(v, "2001-06-01")


@query(
    """SELECT ticker, id FROM {company_listings} WHERE is_active AND id NOT IN (SELECT listing_id FROM {prices})"""
)
def listings_without_prices(v: Views) -> DataFrame:
    return audit.listings_without_prices(v)


@query(
    """SELECT l.ticker, max(p.price_date) AS last_price_date FROM {company_listings} l JOIN {prices} p ON p.listing_id = l.id
    GROUP BY 1 ORDER BY last_price_date DESC, ticker LIMIT 10"""
)
def last_price_dates(v: Views) -> DataFrame:
    return audit.last_price_dates(v, 10)


@query(
    """SELECT id, legal_name, CAST(last_synced_at AS DATE) AS synced FROM {companies} WHERE last_synced_at IS NOT NULL
    ORDER BY last_synced_at DESC, id LIMIT 10"""
)
def recent_syncs(v: Views) -> DataFrame:
    return audit.recent_syncs(v, 10).select("id", "legal_name", F.col("last_synced_at").cast("date").alias("synced"))


@query(
    """SELECT id, status, records_inserted FROM {import_runs} WHERE provider_id = '1'
    ORDER BY finished_at DESC NULLS FIRST, id DESC LIMIT 5""",
    longs="records_inserted",
)
def recent_runs(v: Views) -> DataFrame:
    return audit.recent_runs(v, "1", 5).drop("finished_at")


@query(
    """SELECT company_id, id, pipeline FROM (SELECT *, row_number() OVER (
      PARTITION BY company_id ORDER BY started_at DESC, id DESC) AS rn FROM {import_runs}) r WHERE rn = 1"""
)
def latest_runs(v: Views) -> DataFrame:
    """The last started run of every company."""
    return runs.latest_run(v["import_runs"]).select("company_id", "id", "pipeline")


def _runs(v: Views) -> DataFrame:
    note = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("reason"), F.lit("open"))
    return v["import_runs"].withColumn("errors", F.when(F.col("pipeline") == "view", note))


_NOW = "TIMESTAMP '2024-01-28 00:00:00'"
_AGE = f"date_diff('microsecond', started_at, {_NOW}) / 3600e6"


@query(
    f"""SELECT id, pipeline, 'failed' AS status, CAST(floor(date_diff('microsecond', started_at, {_NOW}) / 1e6) AS BIGINT) AS duration_seconds,
           round({_AGE}, 2) AS age_hours, 'stale_running_closed_by_maintenance' AS reason, 'running' AS previous_status,
           CASE WHEN pipeline = 'view' THEN props ->> '$.k' END AS k
    FROM {{import_runs}} WHERE status = 'running' AND {_AGE} > 100""",
    doubles="age_hours", longs="duration_seconds",
)
def dangling_runs(v: Views) -> DataFrame:
    """Runs open for more than a hundred hours, closed with the reason merged into their notes."""
    closed = runs.close_dangling(_runs(v), "2024-01-28", 100)
    return closed.select(
        "id", "pipeline", "status", "duration_seconds", "age_hours",
        *[F.try_element_at("errors", F.lit(k)).alias(k) for k in ("reason", "previous_status", "k")],
    )


@query(
    """SELECT id, pipeline, 'failed' AS status, 'interrupted: previous run left dangling' AS reason
    FROM {import_runs} WHERE status = 'running' AND provider_id = '2'"""
)
def interrupted_runs(v: Views) -> DataFrame:
    """Open runs of one provider, as closed before the next start."""
    closed = runs.mark_dangling(_runs(v), "2", "2024-01-31", ["click", "view"])
    return closed.select("id", "pipeline", "status", F.try_element_at("errors", F.lit("reason")).alias("reason"))
