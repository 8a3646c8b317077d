"""Jobs that write tables, each read back from what it stored."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.operators import writes
from periodica.operators.writes import ParquetTable
from periodica.plans import audit, history, ingest, refresh, runs
from periodica.plans.core import core_financials
from periodica.schemas import NATURAL_KEYS, schema
from periodica.sources import documents
from periodica.sources.series import fx_from_pairs, parse_membership, parse_sector_feed
from periodica.sources.tables import Catalog, literal_table
from periodica.streaming import landing
from periodica.workload import analysis, basics, layers
from periodica.workload.landing import (
    _TARGETS, _bars, _filing_table, _fresh, _stored_filings, fact_documents, filings_and_facts, universe_documents,
)
from periodica.workload.audits import with_shells
from periodica.workload.registry import QUERIES, query
from periodica.workload.views import Views


def _same(name: str) -> str:
    """The oracle of the frame that the stored form must equal."""
    return QUERIES[name].sql


def _strings(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- documents ------------------------------------------------------------------


@query(
    """SELECT source_id, CASE concept WHEN 'GrossProfit' THEN 'not valid JSON' WHEN 'ProfitLoss' THEN 'document is empty'
           ELSE 'cik is missing' END AS reason
    FROM {financial_facts} WHERE concept IN ('GrossProfit', 'ProfitLoss', 'AssetsCurrent')"""
)
def documents_rejected(v: Views) -> DataFrame:
    """Truncated, empty and incomplete documents, each with its reason; all others are readable."""
    concept, text = F.col("concept"), F.col("value")
    broken = fact_documents(v, "concept", "source_id").withColumn(
        "value",
        F.when(concept == "GrossProfit", F.substring(text, 1, 60)).when(concept == "ProfitLoss", " ")
        .when(concept == "AssetsCurrent", F.regexp_replace(text, '"cik":[0-9]+,', "")).otherwise(text),
    ).drop("concept")
    return documents.rejected_documents(broken, "facts")


@query(
    """SELECT company_id, count(*) AS n, 'value is required' AS errors FROM {financial_facts}
    WHERE concept = 'AssetsCurrent' GROUP BY 1""",
    longs="n",
)
def null_values_rejected(v: Views) -> DataFrame:
    """Reported nulls are rejected facts, not zeros."""
    null = F.regexp_replace("value", '"val":[^,]+,', '"val":null,')
    broken = fact_documents(v, "concept").withColumn("value", F.when(F.col("concept") == "AssetsCurrent", null).otherwise(F.col("value")))
    rows = ingest.fact_rows(documents.parse_company_facts(broken), v["company_identifiers"], _stored_filings(v), "1")
    _, rejects = ingest.validate_facts(rows)
    return rejects.where("concept <> 'GrossProfit'").groupBy("company_id", F.array_join("errors", "; ").alias("errors")).agg(
        F.count("*").alias("n"))


# --- writes ---------------------------------------------------------------------


@query(
    """SELECT 'good' AS load, count(*) AS processed, count(*) AS inserted, 0 AS skipped, false AS failed, count(*) AS stored
    FROM {filings}
    UNION ALL SELECT 'bad', count(*), 0, count(*), true, count(*) FROM {filings}""",
    longs="processed inserted skipped stored",
)
def insert_guarded_result(v: Views) -> DataFrame:
    """A good batch, then one of as many new rows that fails while it is written: nothing of it is stored."""
    table = ParquetTable(v.spark, _fresh(v, "guarded"), schema("filings"))
    batch = _filing_table(v)
    failing = batch.withColumn("accession_number", F.concat(F.lit("x"), "accession_number")).withColumn(
        "fiscal_year", F.when(F.col("form") == "10-K", F.concat(F.lit("no year "), "id").cast("int")).otherwise(F.col("fiscal_year")))
    out = []
    for name, rows in (("good", batch), ("bad", failing)):
        s = writes.insert_guarded(table, rows, NATURAL_KEYS["filings"])
        out.append((name, s.processed, s.inserted, s.skipped, s.error is not None, table.read().count()))
    return literal_table(
        v.spark, out, "load string, processed bigint, inserted bigint, skipped bigint, failed boolean, stored bigint")


def _rate_table(v: Views, name: str) -> tuple[ParquetTable, DataFrame]:
    old, new = basics._rates(v)
    table = ParquetTable(v.spark, _fresh(v, name), old.schema)
    table.replace(old)
    return table, new


@query(_same("upsert_result"), doubles="usd_per_unit")
def upsert_table(v: Views) -> DataFrame:
    table, new = _rate_table(v, "upserted")
    writes.upsert(table, new, ["currency", "rate_date"], "usd_per_unit")
    return table.read()


@query(_same("replace_where_result"), doubles="usd_per_unit")
def replace_where_table(v: Views) -> DataFrame:
    table, new = _rate_table(v, "replaced")
    writes.replace_where(table, F.col("currency") == "GBP", new)
    return table.read()


@query(_same("patch_result"))
def patch_table(v: Views) -> DataFrame:
    """Companies patched from listings, in the table."""
    companies = v["companies"].select("id", "legal_name", "sector", "industry")
    table = ParquetTable(v.spark, _fresh(v, "patched"), companies.schema)
    table.replace(companies)
    news = v["company_listings"].where("is_active").groupBy(F.col("company_id").alias("id")).agg(
        F.when(~F.max("is_primary"), F.concat(F.lit("sector of "), F.max("ticker"))).alias("sector"),
        F.max("exchange_id").alias("industry"),
    )
    writes.patch(table, news, ["id"], ["sector", "industry"])
    return table.read()


@query(_same("currency_backfill"), doubles="value")
def currency_backfill_table(v: Views) -> DataFrame:
    """Missing currencies filled in those years of the stored facts that have any."""
    facts = v["financial_facts"].select("company_id", "source_id", "value", "unit", "currency", "fiscal_year")
    table = ParquetTable(v.spark, _fresh(v, "backfilled"), facts.schema, ["fiscal_year"])
    table.replace(facts)
    writes.backfill_table(table)
    return table.read().drop("fiscal_year")


@query(_same("fx_choice"), doubles="usd_per_unit")
def fx_rates_table(v: Views) -> DataFrame:
    """Chosen rates loaded twice into the rate table."""
    catalog = Catalog(v.spark, _fresh(v, "rates"))
    pairs = fx_from_pairs(layers.pair_closes(v), v["per_eur"].select("currency"))
    for _ in range(2):
        ingest.load_fx_rates(catalog, v["per_eur"], pairs)
    return catalog.table("fx_rates")


@query(f"""WITH {analysis._PARSED}, {analysis._RESOLVED}
    SELECT p.ticker, p.start_date, p.end_date, r.company_id, 'feed' AS source FROM parsed p LEFT JOIN resolved r USING (ticker)""")
def membership_table(v: Views) -> DataFrame:
    """Membership loaded twice, read back."""
    table = ParquetTable(v.spark, _fresh(v, "membership"), schema("index_constituents"))
    parsed = parse_membership(analysis._feed(v))
    listings = analysis._feed_listings(v).withColumn("company_id", F.lpad(F.col("company_id").cast("string"), 12, "0"))
    for day in ("2020-01-01", "2020-01-02"):
        history.load_membership(table, parsed, listings, "feed", day)
    return table.read().select(
        "ticker", "start_date", "end_date", F.col("company_id").cast("bigint").alias("company_id"), "source")


@query(_same("prices_ingest"), doubles="open close adjusted_close", longs="volume listing_id")
def prices_table(v: Views) -> DataFrame:
    """The newest bars loaded twice into the price table, which is partitioned by year."""
    catalog = Catalog(v.spark, _fresh(v, "prices"))
    catalog.store("company_listings").replace(_strings(v["company_listings"], "id", "company_id"))
    catalog.store("exchanges").replace(v["exchanges"])
    for _ in range(2):
        ingest.ingest_prices(catalog, _bars(v), "2")
    return catalog.table("prices").select(
        "listing_id", "price_date", "open", "close", "adjusted_close", "volume", "currency", "source_id")


_ALL_TARGETS = re.sub(r"\s*AND upper\(l.ticker\) NOT IN \([^)]*\)", "", _TARGETS.replace("(ticker)", "[ticker]")).replace("[ticker]", "(ticker)")


@query(
    f"""WITH {_ALL_TARGETS} SELECT c.id, coalesce(c.sector, s.sector) AS sector, coalesce(s.industry, c.industry) AS industry
    FROM {{companies}} c LEFT JOIN (
      SELECT t.company_id, 'Sector ' || min(l.exchange_id) AS sector, 'Industry ' || upper(t.ticker) AS industry
      FROM targets t JOIN {{company_listings}} l ON upper(l.ticker) = upper(t.ticker) GROUP BY t.company_id, t.ticker) s
    ON s.company_id = c.id""",
    longs="id",
)
def sector_table(v: Views) -> DataFrame:
    """Sector and industry filled in the company table from a feed."""
    catalog = Catalog(v.spark, _fresh(v, "sectors"))
    catalog.store("companies").replace(_strings(v["companies"], "id"))
    catalog.store("company_listings").replace(_strings(v["company_listings"], "id", "company_id"))
    catalog.store("exchanges").replace(v["exchanges"])
    feed = parse_sector_feed(v["company_listings"].groupBy(F.lower("ticker").alias("ticker")).agg(
        F.concat(F.lit("Sector "), F.min("exchange_id")).alias("sector"),
        F.concat(F.lit("Industry "), F.upper(F.min("ticker"))).alias("industry")))
    ingest.enrich_sector(catalog, feed)
    return catalog.table("companies").select("id", "sector", "industry")


# --- sync -----------------------------------------------------------------------

_KNOWN = "exchange_id IN ('NASDAQ', 'NYSE', 'NYSEARCA', 'OTC')"


@query(
    f"""SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, ticker,
           CASE WHEN exchange_id = 'NYSE' THEN 2 ELSE 1 END AS listings, 1 AS open
    FROM (SELECT company_id, upper(ticker) AS ticker, exchange_id FROM {{company_listings}}) l WHERE {_KNOWN}""",
    longs="listings open",
)
def relisting(v: Views) -> DataFrame:
    """Tickers that were closed and are listed again get a further, open listing; repeated syncs add none."""
    catalog = Catalog(v.spark, _fresh(v, "relisted"))
    companies = documents.parse_universe(universe_documents(v))
    ingest.ingest_universe(catalog, companies, "1")
    codes = catalog.table("exchanges").where("code = 'NYSE'").select(F.col("id").alias("exchange_id"), F.lit(True).alias("_hit"))
    stored = catalog.table("company_listings")
    closed = stored.join(codes, "exchange_id", "left").withColumn(
        "delisting_date", F.when(F.col("_hit"), F.lit("2020-01-01").cast("date")).otherwise(F.col("delisting_date")))
    catalog.store("company_listings").replace(closed.select(*stored.columns))
    for _ in range(2):
        ingest.ingest_universe(catalog, companies, "1")
    ciks = ingest.company_ids(catalog.table("company_identifiers"))
    return catalog.table("company_listings").join(ciks, "company_id").groupBy("cik", "ticker").agg(
        F.count("*").alias("listings"), F.count_if(F.col("delisting_date").isNull()).alias("open"))


_STORED_FACTS = """SELECT DISTINCT company_id, concept, period_start, period_end, filing_id, namespace FROM {financial_facts}
      WHERE concept NOT IN ('GrossProfit', 'InterestIncomeOperating')"""


@query(
    f"""WITH known AS (SELECT * FROM {{company_listings}} WHERE {_KNOWN}), sums AS (
      SELECT (SELECT count(*) FROM {{companies}}) AS companies, (SELECT count(DISTINCT exchange_id) FROM known) AS exchanges,
             (SELECT count(*) FROM known) AS listings, 2 * (SELECT count(*) FROM {{company_listings}}) AS identifiers,
             (SELECT count(*) FROM {{orders}} WHERE o_orderstatus <> 'F') AS filings,
             (SELECT count(*) FROM ({_STORED_FACTS}) f) AS facts)
    SELECT '2024-01-01' AS day, 'success' AS status, companies + exchanges + listings + identifiers + filings + facts AS records_inserted
    FROM sums UNION ALL SELECT '2024-01-02', 'success', 0 FROM sums""",
    longs="records_inserted",
)
def sync_runs(v: Views) -> DataFrame:
    """The trail of two syncs of the same universe, filings and facts: each is one closed run with its sums."""
    catalog = Catalog(v.spark, _fresh(v, "runs"))
    companies = documents.parse_universe(universe_documents(v))
    for day in ("2024-01-01", "2024-01-02"):
        ingest.sync(catalog, companies, *filings_and_facts(v), "1", day)
    return runs.runs_state(catalog.table("import_runs")).select(
        F.col("started_at").cast("date").cast("string").alias("day"), "status", "records_inserted")


@query(
    """SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, concept, errors, count(*) AS n FROM (
      SELECT DISTINCT company_id, namespace, concept, unit, CAST(value AS DECIMAL(30,2)) AS value, period_start, filing_id,
             'fiscal_year 1985 is outside valid range (1990-2030)' AS errors
      FROM {financial_facts} WHERE concept = 'GrossProfit') r GROUP BY 1, 2, 3""",
    longs="n",
)
def sync_rejects(v: Views) -> DataFrame:
    """Facts that two syncs of the same documents rejected, as stored: each once, with the rules it breaks."""
    catalog = Catalog(v.spark, _fresh(v, "rejects"))
    companies = documents.parse_universe(universe_documents(v))
    for day in ("2024-01-01", "2024-01-02"):
        ingest.sync(catalog, companies, *filings_and_facts(v), "1", day)
    return catalog.table("fact_rejects").groupBy("cik", "concept", "errors").agg(F.count("*").alias("n"))


@query(
    """SELECT 'facts:' || lpad(CAST(company_id AS VARCHAR), 10, '0') AS source_identifier, 'facts' AS step, count(*) AS records_read,
           count(*) FILTER (WHERE concept NOT IN ('GrossProfit', 'InterestIncomeOperating')) AS records_stored,
           count(*) FILTER (WHERE concept = 'GrossProfit') AS records_rejected,
           count(*) FILTER (WHERE concept = 'InterestIncomeOperating') AS records_left_out, 0 AS records_waiting
    FROM {financial_facts} GROUP BY company_id
    UNION ALL SELECT 'submissions:' || lpad(CAST(o_custkey AS VARCHAR), 10, '0'), 'filings', count(*), count(*), 0, 0, 0
    FROM {orders} WHERE o_orderstatus <> 'F' GROUP BY o_custkey""",
    longs="records_read records_stored records_rejected records_left_out records_waiting",
)
def sync_outcomes(v: Views) -> DataFrame:
    """What became of the rows of every document of a sync."""
    catalog = Catalog(v.spark, _fresh(v, "outcomes"))
    ingest.sync(catalog, documents.parse_universe(universe_documents(v)), *filings_and_facts(v), "1", "2024-01-01")
    return catalog.table("document_outcomes").select(
        "source_identifier", "step", "records_read", "records_stored", "records_rejected", "records_left_out", "records_waiting")


@query(
    """SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS source_identifier, CASE WHEN lang = 'fr' THEN 2 ELSE 1 END AS versions,
           CASE WHEN lang = 'de' THEN 0 ELSE 1 END AS processed FROM {documents}""",
    longs="versions processed",
)
def sync_documents(v: Views) -> DataFrame:
    """Documents registered by a sync of filings and facts, flagged unless rejected; changed ones come back as a second version."""
    catalog = Catalog(v.spark, _fresh(v, "registry"))
    name = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))
    scan = documents.checksums(v["documents"], "text", name, F.concat("source", F.lit(".json")))
    lost = v["documents"].where("lang = 'de'").select(name.alias("source_identifier"))
    ingest.sync(catalog, documents.parse_universe(universe_documents(v)), *filings_and_facts(v), "1", "2024-01-01", raw=scan, rejected=lost)
    edited = v["documents"].withColumn("text", F.when(F.col("lang") == "fr", F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    again = documents.checksums(edited, "text", name, F.concat("source", F.lit(".json")))
    ingest.register_documents(catalog, again, "1", "2024-01-02")
    return catalog.table("raw_documents").groupBy("source_identifier").agg(
        F.count("*").alias("versions"), F.count_if("is_processed").alias("processed"))


@query(_same("core_financials_latest_parts"), doubles=layers.AMOUNTS)
def refresh_after_load(v: Views) -> DataFrame:
    """Core financials refreshed after a load of facts; a load that fails leaves them as they were."""
    built = core_financials(v["financial_facts"], v["fx_rates"])
    snapshot = ParquetTable(v.spark, _fresh(v, "refreshed"), built.schema)
    facts = ParquetTable(v.spark, _fresh(v, "loaded"), v["financial_facts"].schema)
    landing.refresh_after(
        lambda: facts.replace(v["financial_facts"]), snapshot, lambda: core_financials(facts.read(), v["fx_rates"]))

    def fails() -> None:
        facts.replace(v["financial_facts"].withColumn("value", F.raise_error(F.lit("broken load")).cast("decimal(30,10)")))

    try:
        landing.refresh_after(fails, snapshot, lambda: core_financials(facts.read(), v["fx_rates"]))
    except Exception as error:  # noqa: BLE001 - the failure is the case under test
        if "broken load" not in str(error):
            raise
    return snapshot.read()


@query(_same("core_financials_latest_parts"), doubles=layers.AMOUNTS)
def refresh_changed_core(v: Views) -> DataFrame:
    """Core financials brought up to date by what three loads of facts and rates changed, each company-year alone."""
    facts = ParquetTable(v.spark, _fresh(v, "facts"), v["financial_facts"].schema, ["fiscal_year"], ["company_id"])
    rates = ParquetTable(v.spark, _fresh(v, "rates"), v["fx_rates"].schema)
    core = refresh.core_table(facts, rates, _fresh(v, "core"))
    early, old = F.col("filing_date") < "1997-01-01", F.col("rate_date") < "1996-01-01"
    loads = [(facts, v["financial_facts"], early), (rates, v["fx_rates"], old), (facts, v["financial_facts"], ~early | early.isNull()),
             (rates, v["fx_rates"], ~old | old.isNull())]
    for table, rows, part in loads:
        table.append(rows.where(part))
        refresh.refresh_core_table(core, facts, rates)
    return core.read()


@query(
    """SELECT c.id, c.legal_name, g.label FROM {companies} c
    JOIN (VALUES ('NATION_1', 'home'), ('NATION_2', 'abroad'), ('NATION_3', 'abroad')) g(country, label) ON g.country = c.country"""
)
def literal_relation(v: Views) -> DataFrame:
    """Companies joined with a relation of constants."""
    groups = literal_table(
        v.spark, [("NATION_1", "home"), ("NATION_2", "abroad"), ("NATION_3", "abroad")], "country string, label string")
    return v["companies"].join(groups, "country").select("id", "legal_name", "label")


@query(_same("relink_filings"))
def relink_filings_table(v: Views) -> DataFrame:
    """Facts stored before their filings, linked in the years that have any."""
    c = F.col
    source = F.concat_ws(
        "|", F.concat(F.lit("9"), c("filing_id").cast("string")), F.concat("namespace", F.lit(":"), "concept"),
        c("period_start").cast("string"), c("period_end").cast("string"))
    facts = v["financial_facts"].select(
        "company_id", F.concat("concept", F.lit(" "), "source_id").alias("concept"), "period_start", "period_end",
        F.lit(None).cast("bigint").alias("filing_id"), "value", source.alias("source_id"), "fiscal_year")
    table = ParquetTable(v.spark, _fresh(v, "relinked"), facts.schema, ["fiscal_year"])
    table.replace(facts)
    landing.relink_table(table, _stored_filings(v))
    return table.read().select("source_id", "filing_id")


@query(_same("tickers_without_facts"))
def ticker_health(v: Views) -> DataFrame:
    """The check over stored tables."""
    catalog = Catalog(v.spark, _fresh(v, "health"))
    for name, rows in with_shells(v).items():
        catalog.store(name).replace(_strings(rows, *[c for c in ("id", "company_id", "filing_id") if c in rows.columns]))
    names = ("companies", "company_listings", "company_identifiers", "financial_facts")
    return audit.tickers_without_facts({n: catalog.table(n) for n in names})
