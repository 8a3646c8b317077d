"""Fixed tables and word lists that results depend on.

The three CSV files next to this module are read on the driver and become local
relations of 66, 9 and 118 rows, so joins against them are always small.
"""

from __future__ import annotations

import csv
from functools import cache
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Forms that carry financial statements.
FINANCIAL_FORMS = (
    "10-K", "10-K/A", "10-Q", "10-Q/A", "20-F", "20-F/A",
    "40-F", "40-F/A", "6-K", "6-K/A", "8-K", "8-K/A",
)

# Forms whose accession prefixes tell who files for a company.
CORE_FORMS = (
    "10-K", "10-K/A", "10-KT", "10-KT/A", "10-Q", "10-Q/A", "10-QT", "10-QT/A",
    "20-F", "20-F/A", "40-F", "40-F/A",
)

# Exchange labels that place a company in the USA.
US_EXCHANGE_LABELS = (
    "NASDAQ", "NYSE", "NYSE AMERICAN", "NYSE ARCA", "BATS", "CBOE",
    "OTC", "OTCQB", "OTCQX", "PINK",
)

# Exchange codes whose plain ticker is a quote symbol.
US_QUOTE_EXCHANGES = ("NYSE", "NASDAQ", "AMEX", "ARCA", "BATS", "NYSEAMERICAN", "NYSEARCA")

# Exchange code to symbol suffix of the CSV price feed.
FEED_SUFFIXES = {
    "NYSE": "us", "NASDAQ": "us", "AMEX": "us", "ARCA": "us", "BATS": "us",
    "NYSEAMERICAN": "us", "NYSEARCA": "us",
    "OTC": "otc", "OTCQB": "otcqb", "OTCQX": "otcqx", "PINK": "pink",
}

# Reasons noted on runs that are closed without having ended.
STALE_RUN_REASON = "stale_running_closed_by_maintenance"
INTERRUPTED_RUN_REASON = "interrupted: previous run left dangling"

# Currencies with a published euro reference rate.
EURO_REFERENCE_CURRENCIES = (
    "AUD", "BRL", "CAD", "CHF", "CNY", "CZK", "DKK", "GBP", "HKD", "HUF",
    "IDR", "ILS", "INR", "ISK", "JPY", "KRW", "MXN", "MYR", "NOK", "NZD",
    "PHP", "PLN", "RON", "SEK", "SGD", "THB", "TRY", "USD", "ZAR",
)

# Codes quoted under a newer code in the pair feed.
PAIR_ALIASES = {"NIS": "ILS", "STD": "STN", "VEF": "VES"}

# Tags read by the yearly analysis queries, per metric.
ANALYSIS_TAGS = {
    "revenue": (
        "Revenues", "Revenue", "SalesRevenueNet",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
    ),
    "net_income": ("NetIncomeLoss", "ProfitLoss", "NetIncome"),
    "total_assets": ("Assets", "AssetsTotal"),
    "stockholders_equity": ("StockholdersEquity", "ShareholdersEquity", "TotalEquity"),
    "total_liabilities": ("Liabilities", "LiabilitiesTotal"),
    "operating_cash_flow": ("OperatingCashFlow", "NetCashProvidedByUsedInOperatingActivities"),
    "capex": ("CapitalExpenditures", "PaymentsToAcquirePropertyPlantAndEquipment"),
    "current_assets": ("AssetsCurrent", "CurrentAssets"),
    "current_liabilities": ("LiabilitiesCurrent", "CurrentLiabilities"),
    "shares_outstanding": ("CommonStockSharesOutstanding", "EntityCommonStockSharesOutstanding"),
}

# Tags of the latest-annual snapshot, which uses its own lists.
SNAPSHOT_TAGS = {
    "revenue": (
        "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "SalesRevenueNet",
        "RevenueFromSalesOfGoodsNet", "RevenueFromServicesNet",
    ),
    "net_income": ("NetIncomeLoss", "ProfitLoss", "NetIncome"),
    "total_assets": ("Assets",),
    "stockholders_equity": ("StockholdersEquity", "ShareholdersEquity", "TotalEquity"),
    "total_liabilities": ("Liabilities",),
}

# Canonical fields of the yearly financials, in output order.
CORE_FIELDS = {
    "net_income": "net_income",
    "operating_income": "operating_income",
    "gross_profit": "gross_profit",
    "total_assets": "total_assets",
    "total_liabilities": "total_liabilities",
    "stockholders_equity": "stockholders_equity",
    "cash": "cash_and_equivalents",
}
CORE_METRICS = ("revenue", *CORE_FIELDS)

# Accepted fiscal years, plausible index size, balance tolerance.
FISCAL_YEARS = (1990, 2030)
INDEX_MEMBERS = (450, 520)
BALANCE_TOLERANCE = 0.01
MARGIN_FACTOR = 1.01


@cache
def rows(name: str) -> tuple[tuple[str | None, ...], ...]:
    """Rows of a packaged CSV (header first), empty cells as None."""
    text = resources.files(__name__).joinpath(f"{name}.csv").read_text(encoding="utf-8")
    lines = [line for line in text.splitlines() if not line.startswith("#")]
    return tuple(tuple(cell or None for cell in row) for row in csv.reader(lines))


def table(spark: SparkSession, name: str) -> DataFrame:
    """A packaged CSV as a local relation of strings.

    It comes from Arrow, so Spark knows its exact size, and it is marked for
    broadcasting: the files are fixed at 118 rows or fewer, and joining facts on
    a few dozen tags by shuffling would put whole tags into single tasks.
    """
    header, *body = rows(name)
    columns = pa.table({column: pa.array([row[i] for row in body], pa.string()) for i, column in enumerate(header)})
    return F.broadcast(spark.createDataFrame(columns))


@cache
def currency_codes() -> tuple[str, ...]:
    """Codes that count as money."""
    return tuple(row[0] for row in rows("currencies")[1:])


@cache
def tags_for(fields: tuple[str, ...]) -> tuple[str, ...]:
    """Every packaged tag that feeds one of the canonical fields."""
    return tuple(sorted({row[1] for row in rows("tag_mapping")[1:] if row[2] in fields}))
