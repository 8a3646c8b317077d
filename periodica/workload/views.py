"""Domain tables derived from the given star-schema tables.

Every view is one SELECT in SQL that both Spark and DuckDB understand, so the
queries and their oracles start from the same rows. ``{name}`` refers to a given
table or to an earlier view.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "companies": """
        SELECT c_custkey AS id, c_name AS legal_name, n_name AS country,
               nullif(c_mktsegment, 'HOUSEHOLD') AS sector, CAST(NULL AS STRING) AS industry,
               'USD' AS currency, c_acctbal >= 0 AS is_active,
               CASE WHEN c_mktsegment <> 'MACHINERY'
                    THEN CAST(make_date(2001, 1 + c_nationkey % 12, 1 + c_nationkey) AS TIMESTAMP) END AS last_synced_at,
               CAST(make_date(1998, 1 + c_nationkey % 12, 1 + c_nationkey) AS TIMESTAMP) AS updated_at
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "company_listings": """
        SELECT c_custkey AS id, c_custkey AS company_id,
               CASE n_regionkey WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' WHEN 2 THEN 'NYSEARCA'
                    WHEN 3 THEN 'OTC' ELSE 'PINK' END AS exchange_id,
               left(c_mktsegment, 1) || CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS STRING) AS ticker,
               CAST(NULL AS STRING) AS share_class,
               make_date(1990 + c_nationkey, 1, 1) AS listing_date,
               CASE WHEN c_acctbal < 0 THEN make_date(2015, 1, 1) END AS delisting_date,
               c_nationkey % 4 <> 0 AS is_primary, c_acctbal >= 0 AS is_active
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "company_identifiers": """
        SELECT c_custkey AS company_id, 'CIK' AS identifier_type,
               lpad(CAST(c_custkey AS STRING), 10, '0') AS identifier_value, '1' AS provider_id, true AS is_primary
        FROM {customer}
        UNION ALL
        SELECT company_id, 'TICKER' AS identifier_type, ticker AS identifier_value, '1' AS provider_id,
               false AS is_primary
        FROM {company_listings}""",
    "exchanges": """
        SELECT DISTINCT exchange_id AS id, exchange_id AS code, 'Exchange ' || exchange_id AS name
        FROM {company_listings}""",
    "data_providers": """
        SELECT CAST(r_regionkey AS STRING) AS id, 'Provider ' || r_name AS name,
               CASE WHEN r_regionkey = 1 THEN 'filings' ELSE 'prices' END AS type
        FROM {region}""",
    "filings": """
        SELECT o_orderkey AS id, o_custkey AS company_id,
               CASE o_orderstatus WHEN 'X' THEN '2' ELSE '1' END AS provider_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-Q'
                    WHEN '3-MEDIUM' THEN '20-F' WHEN '4-NOT SPECIFIED' THEN '10-K/A' ELSE 'DEF 14A' END AS form,
               lpad(CASE o_custkey % 10 WHEN 1 THEN CAST(o_custkey + 1 AS STRING) WHEN 2 THEN '90000001'
                         WHEN 3 THEN '90000002' ELSE CAST(o_custkey AS STRING) END, 10, '0')
                 || '-' || CAST(o_orderkey AS STRING) AS accession_number,
               CAST(o_orderdate AS DATE) AS filing_date, CAST(year(o_orderdate) AS INT) AS fiscal_year,
               'FY' AS fiscal_period, make_date(year(o_orderdate) - 1, 12, 31) AS period_end,
               o_orderkey AS raw_document_id, CAST(o_orderdate AS TIMESTAMP) AS created_at
        FROM {orders}""",
    "financial_facts": """
        SELECT o_custkey AS company_id, o_orderkey AS filing_id,
               CASE o_orderstatus WHEN 'X' THEN '2' ELSE '1' END AS provider_id,
               CASE l_suppkey % 5 WHEN 0 THEN 'ifrs-full' WHEN 1 THEN 'dei' ELSE 'us-gaap' END AS namespace,
               CASE CAST(l_linenumber AS STRING) || l_returnflag
                    WHEN '1A' THEN 'Revenues' WHEN '1N' THEN 'SalesRevenueNet' WHEN '1R' THEN 'OtherRevenue'
                    WHEN '2A' THEN 'NetIncomeLoss' WHEN '2N' THEN 'ProfitLoss' WHEN '2R' THEN 'OperatingIncomeLoss'
                    WHEN '3A' THEN 'Assets' WHEN '3N' THEN 'AssetsTotal'
                    WHEN '3R' THEN 'LiabilitiesAndStockholdersEquity'
                    WHEN '4A' THEN 'Liabilities' WHEN '4N' THEN 'LiabilitiesCurrent' WHEN '4R' THEN 'GrossProfit'
                    WHEN '5A' THEN 'StockholdersEquity'
                    WHEN '5N' THEN 'StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest'
                    WHEN '5R' THEN 'CashAndCashEquivalents'
                    WHEN '6A' THEN 'NetCashProvidedByUsedInOperatingActivities'
                    WHEN '6N' THEN 'RevenueFromSaleOfGoods' WHEN '6R' THEN 'AssetsCurrent'
                    WHEN '7A' THEN 'PaymentsToAcquirePropertyPlantAndEquipment'
                    WHEN '7N' THEN 'CommonStockSharesOutstanding' ELSE 'InterestIncomeOperating' END AS concept,
               CAST(CASE WHEN l_linenumber IN (1, 2, 6) AND l_discount < 0.005 THEN -l_extendedprice
                         WHEN l_linenumber = 1 AND l_quantity <= 3 THEN 0 ELSE l_extendedprice END
                    AS DECIMAL(30,10)) AS value,
               CASE l_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                    ELSE CASE WHEN l_linenumber = 7 THEN 'EUR/shares' ELSE 'XXX' END END AS unit,
               CASE WHEN l_linenumber IN (1, 2, 6) THEN make_date(year(l_shipdate), 1, 1) END AS period_start,
               make_date(year(l_shipdate), 12, 31) AS period_end, CAST(year(l_shipdate) AS INT) AS fiscal_year,
               CASE WHEN l_linestatus = 'F' THEN 'FY' ELSE 'Q3' END AS fiscal_period,
               CAST(l_orderkey AS STRING) || '|' || CAST(l_linenumber AS STRING) || '|' || CAST(l_partkey AS STRING)
                 || '|' || CAST(l_suppkey AS STRING) || '|' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)
                 AS source_id,
               CAST(o_orderdate AS DATE) AS filing_date, CAST(NULL AS STRING) AS currency,
               CAST(o_orderdate AS TIMESTAMP) AS created_at
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    # Daily rates with two decimals; Saturdays and Sundays are missing.
    "fx_rates": """
        SELECT currency, rate_date,
               CAST((CASE currency WHEN 'EUR' THEN 100 ELSE 120 END + k % 40) / 100.0 AS DECIMAL(24,10)) AS usd_per_unit
        FROM (SELECT explode(array('EUR', 'GBP')) AS currency, rate_date, k
              FROM (SELECT CAST(o_orderdate AS DATE) AS rate_date, min(o_orderkey) AS k FROM {orders} GROUP BY 1) d) e
        WHERE extract(DAYOFWEEK_ISO FROM rate_date) <= 5""",
    # Units per euro of several currencies, some quotes zero or missing.
    "per_eur": """
        SELECT currency, rate_date,
               CASE WHEN currency = 'USD' THEN CAST(1 + k % 20 AS DOUBLE) / 16
                    WHEN k % 11 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(CASE currency WHEN 'GBP' THEN 50 WHEN 'JPY' THEN 900 ELSE 200 END + k % 30 AS DOUBLE) / 64
               END AS per_eur
        FROM (SELECT explode(array('USD', 'GBP', 'JPY', 'AED')) AS currency, rate_date, k
              FROM (SELECT CAST(o_orderdate AS DATE) AS rate_date, min(o_orderkey) AS k FROM {orders} GROUP BY 1) d) e
        WHERE NOT (currency = 'USD' AND day(rate_date) = 13)""",
    "prices": """
        SELECT user_id AS listing_id, CAST(ts AS DATE) AS price_date, '2' AS provider_id,
               min_by(value, ts) AS open, max(value) AS high, min(value) AS low, max_by(value, ts) AS close,
               count(*) AS volume
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "dividends": """
        SELECT user_id AS listing_id, CAST(ts AS DATE) AS ex_date, event_id AS source_id,
               CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS amount,
               date_add(CAST(ts AS DATE), CAST(event_id % 9 AS INT) - 1) AS record_date
        FROM {events} WHERE event_type = 'purchase'""",
    "splits": """
        SELECT user_id AS listing_id, CAST(ts AS DATE) AS execution_date, event_id AS source_id,
               CAST(1 + event_id % 4 AS INT) AS numerator, CAST(event_id % 3 AS INT) AS denominator
        FROM {events} WHERE event_type = 'signup'""",
    # Consecutive membership per company: from one order day to the next, the last one open.
    "membership": """
        SELECT 'C' || CAST(o_custkey AS STRING) AS ticker, o_custkey AS company_id, start_date,
               lead(start_date) OVER (PARTITION BY o_custkey ORDER BY start_date) AS end_date
        FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS start_date FROM {orders}
              GROUP BY o_custkey, CAST(o_orderdate AS DATE)) d""",
    "import_runs": """
        SELECT event_id AS id, CASE WHEN event_type = 'click' THEN '2' ELSE '1' END AS provider_id,
               event_type AS pipeline,
               CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' WHEN 'click' THEN 'running'
                    ELSE 'success' END AS status,
               user_id AS company_id, CAST(floor(value) AS BIGINT) AS records_inserted, ts AS started_at,
               CASE WHEN event_type NOT IN ('view', 'click') THEN ts END AS finished_at, props
        FROM {events}""",
    "raw_documents": """
        SELECT doc_id AS id, '1' AS provider_id, 'doc:' || CAST(doc_id AS STRING) AS source_identifier,
               source || '/' || CAST(doc_id AS STRING) || '.json' AS storage_path,
               sha2(text, 256) AS checksum, lang = 'en' AS is_processed,
               CAST(make_date(2000 + CAST(n_chars % 20 AS INT), 1, 1) AS TIMESTAMP) AS retrieved_at
        FROM {documents}""",
}

# The few spots where the two dialects differ.
_DUCK = (
    ("DAYOFWEEK_ISO", "isodow"),
    (r"date_add\(CAST\(ts AS DATE\), ", "(CAST(ts AS DATE) + "),
    (r"explode\(array\(([^)]*)\)\)", r"unnest([\1])"),
    (r"sha2\((\w+), 256\)", r"sha256(\1)"),
)


class Views(Mapping[str, DataFrame]):
    """Given tables and views of one data folder as DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in GIVEN:
                self._built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                text = VIEWS[name]
                used = {n: self[n] for n in references(text)}
                self._built[name] = self.spark.sql(text, **used)
            else:
                raise KeyError(name)
        return self._built[name]

    def stored(self, root: str, partition_by: Mapping[str, str]) -> Views:
        """The same views, each written below ``root`` as a table of its own and read from there."""
        other = Views(self.spark, self.folder)
        for name in VIEWS:
            df, by = self[name], partition_by.get(name)
            if by:
                df = df.repartition(by)
            df.write.partitionBy(*([by] if by else [])).parquet(f"{root}/{name}")
            other._built[name] = self.spark.read.schema(df.schema).parquet(f"{root}/{name}").select(*df.columns)
        return other

    def __iter__(self) -> Iterator[str]:
        return iter((*GIVEN, *VIEWS))

    def __len__(self) -> int:
        return len(GIVEN) + len(VIEWS)


def references(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def duck(body: str) -> str:
    """A DuckDB query whose ``{view}`` references are defined in front of it."""
    needed: dict[str, str] = {}

    def define(text: str) -> None:
        for name in references(text):
            if name in VIEWS and name not in needed:
                define(VIEWS[name])
                needed[name] = VIEWS[name]

    define(body)

    def plain(text: str) -> str:
        for pattern, replacement in _DUCK:
            text = re.sub(pattern, replacement, text)
        return re.sub(r"\{(\w+)\}", r"\1", text).strip()

    heads = [f"{name} AS (\n{plain(text)}\n)" for name, text in needed.items()]
    body = re.sub(r"\{(\w+)\}", r"\1", body).strip()
    if not heads:
        return body
    if re.match(r"WITH\s+RECURSIVE", body, re.I):
        raise ValueError("recursive queries are not used")
    if re.match(r"WITH\s", body, re.I):
        body = re.sub(r"^WITH\s+", "", body, flags=re.I)
        return "WITH " + ",\n".join(heads) + ",\n" + body
    return "WITH " + ",\n".join(heads) + "\n" + body
