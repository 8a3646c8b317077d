"""Sources, ingest, written tables and incremental landing.

Documents are made from table rows, one per row, so nothing is gathered per key;
the parsers then have to give the rows back.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodica import constants
from periodica.functions import facts as rules
from periodica.operators.aggregates import observe_counts
from periodica.operators.writes import ParquetTable, insert_new, overwrite, refresh_snapshot
from periodica.plans import core, ingest, quality
from periodica.schemas import NATURAL_KEYS, schema
from periodica.session import scratch_dir
from periodica.sources import documents, series
from periodica.sources.tables import Catalog
from periodica.streaming import landing
from periodica.workload.layers import _ISSUES, _LATEST, AMOUNTS, CORE, WITH_USD, core_all
from periodica.workload.registry import query
from periodica.workload.views import Views

# --- universe -------------------------------------------------------------------


def _text(column: str | Column) -> Column:
    """A JSON string literal (the given names need no escaping)."""
    return F.concat(F.lit('"'), column, F.lit('"'))


def _json(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


_LABEL = """CASE exchange_id WHEN 'NASDAQ' THEN ' Nasdaq' WHEN 'NYSE' THEN 'NYSE' WHEN 'NYSEARCA' THEN 'NYSE Arca'
      WHEN 'OTC' THEN 'otc' ELSE 'Euronext' END"""


def _listed(v: Views) -> DataFrame:
    names = v["companies"].select(F.col("id").alias("company_id"), "legal_name")
    return v["company_listings"].join(names, "company_id").withColumn("label", F.expr(_LABEL))


def universe_documents(v: Views) -> DataFrame:
    """List layout, with entries that have to be skipped."""
    entry = _json("[", F.col("company_id").cast("string"), ",", _text("legal_name"), ",",
                  _text(F.lower("ticker")), ",", _text("label"), ',"7372"]')
    bad = ',null,["1","short"],["12ab","not a number","X","NYSE"]'
    return _listed(v).select(_json('{"fields":["cik"],"data":[', entry, bad, "]}").alias("value"))


@query(
    f"""SELECT lpad(CAST(l.company_id AS VARCHAR), 10, '0') AS cik, c.legal_name AS name, lower(l.ticker) AS ticker,
           {_LABEL} AS exchange, '7372' AS sic, CAST(NULL AS VARCHAR) AS sic_description, CAST(NULL AS VARCHAR) AS owner_org
    FROM {{company_listings}} l JOIN {{companies}} c ON c.id = l.company_id"""
)
def universe_list(v: Views) -> DataFrame:
    """Company universe from list documents."""
    return documents.parse_universe(universe_documents(v))


@query(
    """SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, legal_name AS name, ticker, '' AS exchange
    FROM {company_listings} l JOIN {companies} c ON c.id = l.company_id"""
)
def universe_map(v: Views) -> DataFrame:
    """Company universe from keyed documents."""
    entry = _json('{"cik_str":', F.col("company_id").cast("string"), ',"ticker":', _text("ticker"), ',"title":',
                  _text("legal_name"), "}")
    docs = _listed(v).select(_json('{"0":', entry, ',"1":{"cik_str":5,"ticker":"X"},"note":{"cik_str":7}}').alias("value"))
    return documents.parse_universe(docs).select("cik", "name", "ticker", "exchange")


@query(
    """SELECT l.company_id, CASE WHEN exchange_id = 'PINK' THEN NULL ELSE exchange_id END AS exchange_code,
           CASE WHEN exchange_id = 'PINK' THEN 'FOREIGN' ELSE 'USA' END AS country
    FROM {company_listings} l"""
)
def exchange_mapping(v: Views) -> DataFrame:
    """Exchange labels matched without regard to case and blanks; unknown ones stay unmatched."""
    from periodica.functions import keys

    mapped = ingest.map_exchange(_listed(v), "label")
    return mapped.select("company_id", "exchange_code", keys.country(F.col("label")).alias("country"))


@query(
    """SELECT lpad(CAST(id AS VARCHAR), 10, '0') AS cik, t.kind AS identifier_type,
           CASE t.kind WHEN 'CIK' THEN lpad(CAST(company_id AS VARCHAR), 10, '0') ELSE upper(ticker) END AS identifier_value,
           t.kind = 'CIK' AS is_primary
    FROM {company_listings} l, (VALUES ('CIK'), ('TICKER')) t(kind)"""
)
def universe_identifiers(v: Views) -> DataFrame:
    """Identifiers of parsed companies: number (primary) and ticker."""
    parsed = ingest.parse_companies(documents.parse_universe(universe_documents(v)))
    found = ingest.explode_identifiers(parsed.withColumn("company_id", F.col("cik")))
    return found.withColumnRenamed("company_id", "cik")


@query(
    """WITH wanted AS (SELECT DISTINCT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, lower(ticker) AS ticker FROM {company_listings}
    WHERE company_id IN (SELECT o_custkey FROM wanted)"""
)
def universe_restricted(v: Views) -> DataFrame:
    """Universe cut down to a list of numbers, one per line, padded or not."""
    lines = v["orders"].where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(
        F.concat(F.lit(" 00"), F.col("o_custkey").cast("string")).alias("value")
    )
    wanted = series.parse_key_list(lines)
    return series.restrict_universe(documents.parse_universe(universe_documents(v)), wanted).select("cik", "ticker")


# --- filings --------------------------------------------------------------------


def submission_documents(v: Views) -> DataFrame:
    number = F.concat(F.lpad(F.col("company_id").cast("string"), 10, "0"), F.lit("-95-"), F.col("id").cast("string"))
    day = F.col("filing_date").cast("string")
    report = F.when(F.col("form") == "10-Q", F.lit("")).otherwise(F.col("period_end").cast("string"))
    period = F.when(F.col("form") == "10-Q", F.lit("null")).otherwise(F.lit('"FY"'))
    return v["filings"].select(
        _json(
            '{"cik":"', F.col("company_id").cast("string"), '","name":"n","filings":{"recent":{"accessionNumber":[',
            _text(number), '],"filingDate":[', _text(day), '],"reportDate":[', _text(report), '],"form":[', _text("form"),
            '],"primaryDocument":["d.htm"],"fy":[', F.col("fiscal_year").cast("string"), '],"fp":[', period, "]}}}",
        ).alias("value")
    )


_NUMBER = "lpad(CAST(company_id AS VARCHAR), 10, '0') || '95' || CAST(id AS VARCHAR)"
_URL = f"'{documents.FILE_URL}' || CAST(company_id AS VARCHAR) || '/' || {_NUMBER} || '/d.htm'"


@query(
    f"""SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, {_NUMBER} AS accession_number, form, filing_date,
           CASE WHEN form <> '10-Q' THEN period_end END AS period_end, fiscal_year,
           CASE WHEN form <> '10-Q' THEN 'FY' END AS fiscal_period, {_URL} AS filing_url, form LIKE '%/A' AS is_amended,
           'd.htm' AS primary_document, CAST(NULL AS VARCHAR) AS primary_doc_description
    FROM {{filings}}"""
)
def submissions_explode(v: Views) -> DataFrame:
    """Filings from the parallel arrays of submission documents."""
    return documents.parse_submissions(submission_documents(v))


@query(
    f"""SELECT company_id, {_NUMBER} AS accession_number, form, filing_date, CASE WHEN form <> '10-Q' THEN period_end END AS period_end,
           fiscal_year, 'FY' AS fiscal_period, form LIKE '%/A' AS is_amended
    FROM {{filings}} WHERE form IN ({", ".join(f"'{f}'" for f in constants.FINANCIAL_FORMS)})"""
)
def filings_ingest(v: Views) -> DataFrame:
    """Financial filings of known companies, as they are stored."""
    rows = ingest.filing_rows(documents.parse_submissions(submission_documents(v)), v["company_identifiers"], "1")
    return rows.select(
        "company_id", "accession_number", "form", "filing_date", "period_end", "fiscal_year", "fiscal_period", "is_amended"
    )


# --- facts ----------------------------------------------------------------------


def fact_documents(v: Views, *keep: str) -> DataFrame:
    """One document per fact; some values are no numbers, some years out of range."""
    start = F.when(F.col("period_start").isNull(), F.lit("")).otherwise(
        _json('"start":', _text(F.col("period_start").cast("string")), ",")
    )
    end = F.when(F.col("concept") == "GrossProfit", F.lit("1985-12-31")).otherwise(F.col("period_end").cast("string"))
    # Plain digits: a decimal written out, and a text where no number was reported.
    val = F.when(F.col("concept") == "InterestIncomeOperating", F.lit('"n/a"')).otherwise(
        F.col("value").cast("decimal(30,2)").cast("string")
    )
    return v["financial_facts"].select(
        *keep,
        _json(
            '{"cik":', F.col("company_id").cast("string"), ',"entityName":"n","facts":{', _text("namespace"), ":{",
            _text("concept"), ':{"label":"l","units":{', _text("unit"), ":[{", start, '"end":', _text(end), ',"val":', val,
            ',"accn":', _text(F.concat(F.lit("9-"), F.col("filing_id").cast("string"))), ',"fy":2050,"fp":',
            _text("fiscal_period"), ',"form":"10-K","filed":', _text(F.col("filing_date").cast("string")), "}]}}}}}",
        ).alias("value")
    )


@query(
    """SELECT lpad(CAST(company_id AS VARCHAR), 10, '0') AS cik, namespace, concept, unit,
           CASE WHEN concept = 'InterestIncomeOperating' THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(30,2)) AS VARCHAR) END AS val,
           period_start AS start, CASE WHEN concept = 'GrossProfit' THEN DATE '1985-12-31' ELSE period_end END AS "end",
           '9-' || CAST(filing_id AS VARCHAR) AS accn, fiscal_period AS fp, filing_date AS filed
    FROM {financial_facts}"""
)
def companyfacts_explode(v: Views) -> DataFrame:
    """Reported values from the nested maps of company-facts documents."""
    return documents.parse_company_facts(fact_documents(v)).select(
        "cik", "namespace", "concept", "unit", "val", "start", "end", "accn", "fp", "filed"
    )


def _stored_filings(v: Views) -> DataFrame:
    """Filings under the numbers the fact documents use; finished orders have none."""
    return v["orders"].where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company_id"),
        F.concat(F.lit("9"), F.col("o_orderkey").cast("string")).alias("accession_number"),
    )


def _ingested(v: Views) -> DataFrame:
    values = documents.parse_company_facts(fact_documents(v))
    return ingest.fact_rows(values, v["company_identifiers"], _stored_filings(v), "1")


_SOURCE = """'9' || CAST(f.filing_id AS VARCHAR) || '|' || namespace || ':' || concept
      || coalesce('|' || CAST(period_start AS VARCHAR), '') || '|' || CAST(period_end AS VARCHAR)"""


@query(
    f"""SELECT f.company_id, f.concept, f.value, f.unit, f.period_start, f.period_end, CAST(year(f.period_end) AS INT) AS fiscal_year,
           f.fiscal_period, f.filing_date, o.o_orderkey AS filing_id, {_SOURCE} AS source_id
    FROM {{financial_facts}} f LEFT JOIN {{orders}} o ON o.o_orderkey = f.filing_id AND o.o_orderstatus <> 'F'
    WHERE f.concept NOT IN ('GrossProfit', 'InterestIncomeOperating')""",
    doubles="value",
)
def facts_ingest(v: Views) -> DataFrame:
    """Valid facts out of documents: parsed, normalized, linked and checked."""
    valid, _ = ingest.validate_facts(_ingested(v))
    return valid.select(
        "company_id", "concept", "value", "unit", "period_start", "period_end", "fiscal_year", "fiscal_period",
        "filing_date", "filing_id", "source_id",
    )


@query(
    """SELECT company_id, concept, 'fiscal_year 1985 is outside valid range (1990-2030)' AS errors, count(*) AS n
    FROM {financial_facts} WHERE concept = 'GrossProfit' GROUP BY 1, 2""",
    longs="n",
)
def facts_rejected(v: Views) -> DataFrame:
    """Rejected facts per company with the rule they break."""
    _, rejects = ingest.validate_facts(_ingested(v))
    return rejects.groupBy("company_id", "concept", F.array_join("errors", "; ").alias("errors")).agg(
        F.count("*").alias("n")
    )


@query(
    """WITH broken AS (
      SELECT source_id, CASE WHEN concept <> 'Assets' THEN concept ELSE ' ' END AS concept,
             nullif(namespace, 'dei') AS namespace, CASE WHEN unit <> 'XXX' THEN value END AS value,
             nullif(unit, 'GBP') AS unit, CASE WHEN fiscal_year <> 1999 THEN period_end END AS period_end,
             CASE fiscal_year WHEN 1998 THEN 1900 WHEN 1997 THEN NULL ELSE fiscal_year END AS fiscal_year,
             CASE WHEN fiscal_period = 'FY' THEN 'FY' ELSE '' END AS fiscal_period,
             CASE WHEN fiscal_year = 1996 THEN DATE '1997-06-30' ELSE period_start END AS period_start,
             concept LIKE '%Revenue%' AS is_instant FROM {financial_facts})
    SELECT source_id, concat_ws('; ',
        CASE WHEN concept = ' ' THEN 'concept is required' END,
        CASE WHEN namespace IS NULL THEN 'namespace is required' END,
        CASE WHEN value IS NULL THEN 'value is required' END,
        CASE WHEN unit IS NULL THEN 'unit is required' END,
        CASE WHEN period_end IS NULL THEN 'period_end is required' END,
        CASE WHEN fiscal_year IS NULL THEN 'fiscal_year is required' END,
        CASE WHEN fiscal_year < 1990 THEN 'fiscal_year 1900 is outside valid range (1990-2030)' END,
        CASE WHEN fiscal_period = '' THEN 'fiscal_period is required' END,
        CASE WHEN period_start > period_end THEN 'period_start must be <= period_end' END,
        CASE WHEN is_instant AND period_start IS NOT NULL THEN 'instant facts must have period_start = NULL' END,
        CASE WHEN NOT is_instant AND period_start IS NULL THEN 'duration facts must have period_start != NULL' END) AS errors
    FROM broken"""
)
def fact_validation(v: Views) -> DataFrame:
    """All messages of every fact, over facts that break each of the rules."""
    c = F.col
    year = c("fiscal_year")
    broken = v["financial_facts"].select(
        "source_id",
        F.when(c("concept") != "Assets", c("concept")).otherwise(" ").alias("concept"),
        F.nullif("namespace", F.lit("dei")).alias("namespace"),
        F.when(c("unit") != "XXX", c("value")).alias("value"),
        F.nullif("unit", F.lit("GBP")).alias("unit"),
        F.when(year != 1999, c("period_end")).alias("period_end"),
        F.when(year == 1998, 1900).when(year != 1997, year).alias("fiscal_year"),
        F.when(c("fiscal_period") == "FY", "FY").otherwise("").alias("fiscal_period"),
        F.when(year == 1996, F.lit("1997-06-30").cast("date")).otherwise(c("period_start")).alias("period_start"),
        c("concept").contains("Revenue").alias("is_instant"),
    )
    return broken.select("source_id", F.array_join(rules.errors(c("is_instant")), "; ").alias("errors"))


@query(
    f"""SELECT f.source_id, o.o_orderkey AS filing_id FROM (
      SELECT company_id, filing_id, {_SOURCE} AS source_id, source_id AS row_key FROM {{financial_facts}} f) f
    LEFT JOIN {{orders}} o ON o.o_orderkey = f.filing_id AND o.o_orderstatus <> 'F'"""
)
def relink_filings(v: Views) -> DataFrame:
    """Facts stored before their filings, linked afterwards."""
    c = F.col
    source = F.concat_ws(
        "|", F.concat(F.lit("9"), c("filing_id").cast("string")), F.concat("namespace", F.lit(":"), "concept"),
        c("period_start").cast("string"), c("period_end").cast("string"),
    )
    # The row's own key keeps facts apart that differ in nothing but their value.
    facts = v["financial_facts"].select(
        "company_id", F.concat("concept", F.lit(" "), "source_id").alias("concept"), "period_start", "period_end",
        "filing_id", (c("fiscal_period") == "Q3").alias("_late"), "value", source.alias("source_id"),
    )
    known = _stored_filings(v).select(c("id").alias("_known"))
    # On the number by which the view has joined its lines, so that they stay where they are.
    partly = facts.join(known, (c("filing_id") == c("_known")) & c("_late"), "left").select(
        *[x for x in facts.columns if x not in ("filing_id", "_late")], c("_known").alias("filing_id")
    )
    return landing.relink_filings(partly, _stored_filings(v)).select("source_id", "filing_id")


# --- prices, rates, sectors -------------------------------------------------------


@query(
    """SELECT event_type AS symbol, CAST(ts AS DATE) AS price_date,
           CASE WHEN event_type <> 'click' THEN value END AS open, value + 1 AS high, value - 1 AS low, value AS close,
           CASE WHEN event_type <> 'view' THEN event_id END AS volume
    FROM {events} WHERE event_type <> 'signup' AND event_type <> 'error'""",
    doubles="open high low close", longs="volume",
)
def ohlcv_parse(v: Views) -> DataFrame:
    """Daily bars from text cells: blanks become NULL, rows with a bad cell are skipped."""
    kind, value = F.col("event_type"), F.col("value")
    text = v["events"].select(
        kind.alias("symbol"),
        F.when(kind == "error", "2024-13-01").otherwise(F.col("ts").cast("date").cast("string")).alias("Date"),
        F.when(kind == "click", "").otherwise(value.cast("string")).alias("Open"),
        (value + 1).cast("string").alias("High"),
        (value - 1).cast("string").alias("Low"),
        F.when(kind == "signup", "n/a").otherwise(value.cast("string")).alias("Close"),
        F.when(kind == "view", " ").otherwise(F.col("event_id").cast("string")).alias("Volume"),
    )
    return series.parse_ohlcv(text, F.col("symbol"))


@query(
    """SELECT currency, rate_date, per_eur FROM {per_eur}
    WHERE currency NOT IN ('JPY', 'AED')""",
    doubles="per_eur",
)
def fx_csv_parse(v: Views) -> DataFrame:
    """Euro reference rates from text cells; blank values and bad days are dropped."""
    code = F.col("currency")
    text = v["per_eur"].select(
        "currency",
        F.when(code == "AED", "2024-02-30").otherwise(F.col("rate_date").cast("string")).alias("TIME_PERIOD"),
        F.when(code == "JPY", " ").otherwise(F.col("per_eur").cast("string")).alias("OBS_VALUE"),
    )
    return series.parse_fx(text, code)


def _bars(v: Views) -> DataFrame:
    tickers = v["company_listings"].select(F.col("id").alias("listing_id"), F.upper("ticker").alias("symbol"))
    decimal = [F.col(c).cast("decimal(20,6)").alias(c) for c in ("open", "high", "low", "close")]
    return v["prices"].join(tickers, "listing_id").select("symbol", "price_date", *decimal, "volume")


@query(
    """WITH bars AS (SELECT upper(l.ticker) AS symbol, p.price_date, p.close, p.volume, p.open FROM {prices} p
                     JOIN {company_listings} l ON l.id = p.listing_id),
    newest AS (SELECT DISTINCT ON (symbol) * FROM bars ORDER BY symbol, price_date DESC, close DESC, volume DESC)
    SELECT l.id AS listing_id, n.price_date, n.open, n.close, n.close AS adjusted_close, n.volume, 'USD' AS currency,
           'quotes:' || n.symbol AS source_id
    FROM {company_listings} l JOIN newest n ON n.symbol = upper(l.ticker)
    WHERE l.is_active AND l.exchange_id IN ('NASDAQ', 'NYSE', 'NYSEARCA')""",
    doubles="open close adjusted_close", longs="volume",
)
def prices_ingest(v: Views) -> DataFrame:
    """Newest bar of every active listing on a supported exchange, as stored."""
    rows = ingest.price_rows(v["company_listings"], v["exchanges"], _bars(v), "2")
    return rows.select("listing_id", "price_date", "open", "close", "adjusted_close", "volume", "currency", "source_id")


_TARGETS = """targets AS (SELECT DISTINCT ON (c.id) c.id AS company_id, l.ticker, c.legal_name FROM {companies} c
      JOIN {company_listings} l ON l.company_id = c.id AND l.is_active
      WHERE c.sector IS NULL AND l.exchange_id IN ('NASDAQ', 'NYSE', 'NYSEARCA')
        AND upper(l.ticker) NOT IN (SELECT upper(ticker) FROM {company_listings} WHERE NOT is_active)
      ORDER BY c.id, l.is_primary DESC, l.ticker)"""


def _sector_targets(v: Views) -> DataFrame:
    attempted = v["company_listings"].where("NOT is_active").select(F.lower("ticker").alias("ticker"))
    return ingest.sector_targets(v["companies"], v["company_listings"], v["exchanges"], attempted)


@query(f"WITH {_TARGETS} SELECT * FROM targets")
def sector_targets(v: Views) -> DataFrame:
    """Companies still without a sector, one US ticker each, not tried before."""
    return _sector_targets(v)


@query(
    f"""WITH {_TARGETS} SELECT c.id, coalesce(c.sector, s.sector) AS sector, coalesce(s.industry, c.industry) AS industry
    FROM {{companies}} c LEFT JOIN (
      SELECT t.company_id, 'Sector ' || min(l.exchange_id) AS sector, 'Industry ' || upper(t.ticker) AS industry
      FROM targets t JOIN {{company_listings}} l ON upper(l.ticker) = upper(t.ticker) GROUP BY t.company_id, t.ticker) s
    ON s.company_id = c.id"""
)
def sector_enrichment(v: Views) -> DataFrame:
    """Companies with sector and industry filled in from a feed keyed by ticker."""
    feed = series.parse_sector_feed(
        v["company_listings"].select(
            F.concat(F.lit(" "), F.lower("ticker")).alias("ticker"),
            F.concat(F.lit("Sector "), "exchange_id").alias("sector"),
            F.concat(F.lit("Industry "), F.upper("ticker")).alias("industry"),
        )
    )
    return ingest.enriched_companies(v["companies"], _sector_targets(v), feed).select("id", "sector", "industry")


# --- raw documents ----------------------------------------------------------------


@query(
    """SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS source_identifier, source || '.json' AS storage_path,
           sha256(text) AS checksum, 'application/json' AS content_type FROM {documents}"""
)
def raw_checksums(v: Views) -> DataFrame:
    """Registry rows with checksums over whole contents."""
    return documents.checksums(
        v["documents"], "text", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), F.concat("source", F.lit(".json"))
    )


@query(
    """SELECT source_identifier, checksum FROM {raw_documents} r JOIN {documents} d ON d.doc_id = r.id
    WHERE d.lang IN ('de', 'fr')"""
)
def changed_documents(v: Views) -> DataFrame:
    """Contents that are new (German) or differ from the registered ones (French)."""
    lang = v["documents"].select(F.col("doc_id").alias("id"), "lang")
    registry = v["raw_documents"].join(lang, "id").where("lang <> 'de'").select(
        "source_identifier", F.when(F.col("lang") == "fr", "outdated").otherwise(F.col("checksum")).alias("checksum")
    )
    return landing.changed_documents(v["raw_documents"].select("source_identifier", "checksum"), registry)


@query("SELECT id, source_identifier FROM {raw_documents} WHERE NOT is_processed AND provider_id = '1'")
def pending_documents(v: Views) -> DataFrame:
    return landing.pending_documents(v["raw_documents"], "1").select("id", "source_identifier")


@query(
    """SELECT company_id, concept, period_end, source_id, value FROM {financial_facts}""",
    doubles="value",
)
def dedup_versions(v: Views) -> DataFrame:
    """A batch delivered twice: repetitions fold, restatements stay."""
    columns = ["company_id", "concept", "period_start", "period_end", "filing_id", "source_id", "value"]
    batch = v["financial_facts"].select(*columns)
    return landing.dedup_versions(batch.unionByName(batch), columns[:-1]).select(
        "company_id", "concept", "period_end", "source_id", "value"
    )


# --- written tables ---------------------------------------------------------------


def _fresh(v: Views, name: str) -> str:
    """A new folder below the shared one, so that every run starts empty."""
    return f"{scratch_dir(v.spark)}/workload/{name}-{uuid4().hex}"


def _filing_table(v: Views) -> DataFrame:
    return v["filings"].select(
        *[F.col(c).cast("string") for c in ("id", "company_id", "provider_id", "form", "accession_number")],
        "filing_date", "period_end", "fiscal_year", "fiscal_period",
    )


_FILINGS = """SELECT CAST(id AS VARCHAR) AS id, CAST(company_id AS VARCHAR) AS company_id, form, accession_number,
      filing_date, fiscal_year FROM {filings}"""
_FILING_COLUMNS = ("id", "company_id", "form", "accession_number", "filing_date", "fiscal_year")


@query(_FILINGS)
def insert_table(v: Views) -> DataFrame:
    """A stored table after inserting part of a batch and then all of it twice."""
    table = ParquetTable(v.spark, _fresh(v, "filings"), schema("filings"))
    batch = _filing_table(v)
    for part in (batch.where("form = '10-K'"), batch, batch):
        insert_new(table, part, NATURAL_KEYS["filings"])
    return table.read().select(*_FILING_COLUMNS)


@query(
    """SELECT 'first' AS load, count(*) AS processed, count(*) AS inserted, 0 AS skipped FROM {filings} WHERE form = '10-K'
    UNION ALL SELECT 'second', count(*), count(*) FILTER (WHERE form <> '10-K'), count(*) FILTER (WHERE form = '10-K') FROM {filings}
    UNION ALL SELECT 'third', count(*), 0, count(*) FROM {filings}""",
    longs="processed inserted skipped",
)
def insert_table_counters(v: Views) -> DataFrame:
    """What each of these three loads reports."""
    table = ParquetTable(v.spark, _fresh(v, "filings"), schema("filings"))
    batch = _filing_table(v)
    loads = {"first": batch.where("form = '10-K'"), "second": batch, "third": batch}
    stats = {name: insert_new(table, part, NATURAL_KEYS["filings"]) for name, part in loads.items()}
    return v.spark.createDataFrame(
        [(name, s.processed, s.inserted, s.skipped) for name, s in stats.items()],
        "load string, processed bigint, inserted bigint, skipped bigint",
    )


@query(f"WITH {CORE} {WITH_USD}", doubles=AMOUNTS)
def snapshot_refresh(v: Views) -> DataFrame:
    """Core financials stored as a snapshot, refreshed, and read back."""
    derived = core.core_financials(v["financial_facts"], v["fx_rates"], component_versions="all")
    table = ParquetTable(v.spark, _fresh(v, "core"), derived.schema)
    refresh_snapshot(table, derived.where("currency = 'EUR'"))
    refresh_snapshot(table, derived)
    return table.read()


@query(_LATEST + " UNION ALL ".join(_ISSUES.values()), doubles="value")
def overwrite_issues(v: Views) -> DataFrame:
    """The issue table truncated and reloaded."""
    table = ParquetTable(v.spark, _fresh(v, "issues"), schema("data_quality_issues"))
    found = quality.quality_issues(core_all(v), 1996, "1998-06-30")
    overwrite(table, found.where("severity = 'error'"))
    overwrite(table, found)
    return table.read().select(
        F.col("company_id").cast("bigint").alias("company_id"), F.col("fiscal_year").cast("int").alias("fiscal_year"),
        "field", "issue_type", "severity", "value",
    )


@query(_FILINGS)
def incremental_landing(v: Views) -> DataFrame:
    """Orders landed as a stream of files into the filings table, run twice over the same files."""
    root = _fresh(v, "landing")
    given = v["orders"]

    def parse(batch: DataFrame) -> DataFrame:
        # The view's own definition, applied to the rows of this batch.
        from periodica.workload.views import VIEWS

        return _filing_table({"filings": batch.sparkSession.sql(VIEWS["filings"], orders=batch)})

    table = ParquetTable(v.spark, f"{root}/filings", schema("filings"))
    sink = landing.insert_sink(table, NATURAL_KEYS["filings"], parse)
    for _ in range(2):
        # The table's own path, be it one file or a folder of part files.
        landing.land_incremental(
            v.spark, f"{v.folder}/orders.parquet", sink, "orders", "parquet", given.schema, f"{root}/checkpoint"
        )
    return table.read().select(*_FILING_COLUMNS)


@query(
    """SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, max(o_totalprice) AS largest FROM {orders}""",
    doubles="largest", longs="rows finished",
)
def batch_counters(v: Views) -> DataFrame:
    """Counters gathered while a batch is written, without a second pass."""
    counted, seen = observe_counts(
        v["orders"], "orders", finished=F.count_if(F.col("o_orderstatus") == "F"), largest=F.max("o_totalprice")
    )
    counted.write.parquet(_fresh(v, "counted"))
    row = (seen.get["rows"], seen.get["finished"], seen.get["largest"])
    return v.spark.createDataFrame([row], "rows bigint, finished bigint, largest double")


def filings_and_facts(v: Views) -> tuple[DataFrame, DataFrame]:
    """The stored filings and the facts of all fact documents, as a sync takes them."""
    filings = _stored_filings(v).select(
        F.lpad(F.col("company_id").cast("string"), 10, "0").alias("cik"), "accession_number",
        F.lit("10-K").alias("form"), F.lit(None).cast("date").alias("filing_date"), F.lit(None).cast("date").alias("period_end"),
        F.lit(None).cast("int").alias("fiscal_year"), F.lit(None).cast("string").alias("fiscal_period"),
        F.lit(None).cast("string").alias("filing_url"), F.lit(False).alias("is_amended"),
    )
    return filings, documents.parse_company_facts(fact_documents(v))


@query(
    f"""SELECT lpad(CAST(f.company_id AS VARCHAR), 10, '0') AS cik, f.concept, f.value, f.unit, f.period_start, f.period_end,
           {_SOURCE} AS source_id, o.o_orderkey IS NOT NULL AS linked
    FROM (SELECT DISTINCT ON (company_id, concept, period_start, period_end, filing_id, namespace) *
          FROM {{financial_facts}} WHERE concept NOT IN ('GrossProfit', 'InterestIncomeOperating')
          ORDER BY company_id, concept, period_start, period_end, filing_id, namespace, value, unit, fiscal_period) f
    LEFT JOIN {{orders}} o ON o.o_orderkey = f.filing_id AND o.o_orderstatus <> 'F'""",
    doubles="value",
)
def sync_companies(v: Views) -> DataFrame:
    """Universe, filings and facts of all companies loaded into empty tables, run twice, read back."""
    catalog = Catalog(v.spark, _fresh(v, "sync"))
    universe = documents.parse_universe(universe_documents(v))
    for _ in range(2):
        ingest.sync(catalog, universe, *filings_and_facts(v), "1", "2024-01-01")
    numbers = ingest.company_ids(catalog.table("company_identifiers"))
    return catalog.table("financial_facts").join(numbers, "company_id").select(
        "cik", "concept", "value", "unit", "period_start", "period_end", "source_id",
        F.col("filing_id").isNotNull().alias("linked"),
    )
