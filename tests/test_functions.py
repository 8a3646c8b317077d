"""Row rules: keys, money, facts."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from periodica.functions import facts, keys, money
from periodica.plans.ingest import normalize_facts, validate_facts


def one(spark, expression, *values):
    names = [f"c{i}" for i in range(len(values))]
    row = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return row.select(expression(*[F.col(n) for n in names]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("320193", "0000320193"), ("0000320193", "0000320193"), (" 320193 ", "0000320193"), ("0", "0000000000"),
     ("", "0000000000"), ("12345678901", "12345678901")],
)
def test_cik(spark, raw, want):
    assert one(spark, keys.cik, raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("0000320193-23-000106", "000032019323000106"), ("000032019323000106", "000032019323000106"),
     (" 0000320193-23-000106 ", "000032019323000106"), ("", "")],
)
def test_accession(spark, raw, want):
    assert one(spark, keys.accession, raw) == want


@pytest.mark.parametrize(("raw", "want"), [(" brk.b ", "BRK-B"), ("AAPL", "AAPL"), ('"ge"', "GE")])
def test_ticker(spark, raw, want):
    assert one(spark, keys.ticker, raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Nasdaq", "USA"), ("nyse american", "USA"), (" CBOE ", "USA"), ("LSE", "FOREIGN"), ("", "UNKNOWN"), ("  ", "UNKNOWN"),
     (None, "UNKNOWN")],
)
def test_country(spark, raw, want):
    assert one(spark, keys.country, raw) == want


@pytest.mark.parametrize(
    ("unit", "want"),
    [("EUR", "EUR"), ("GBP/shares", "GBP"), ("usd", "USD"), (" eur ", "EUR"), ("shares", None), ("pure", None),
     ("XAU", None), ("CLF", "CLF"), ("", None), (None, None)],
)
def test_currency_from_unit(spark, unit, want):
    assert one(spark, money.currency_from_unit, unit) == want


@pytest.mark.parametrize(
    ("code", "feed", "want"),
    [("NYSE", "quotes", "AAPL"), ("nasdaq", "quotes", "AAPL"), ("OTC", "quotes", None), ("OTC", "csv", "aapl.otc"),
     ("NYSEARCA", "csv", "aapl.us"), ("LSE", "csv", None)],
)
def test_quote_symbol(spark, code, feed, want):
    assert one(spark, lambda t, e: keys.quote_symbol(t, e, feed), "aapl", code) == want


def test_row_id_keeps_parts_apart(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", None), ("abc", "")], "x string, y string")
    assert rows.select(keys.row_id("x", "y")).distinct().count() == 4


def test_packed_codes_keep_their_order(spark):
    codes = spark.createDataFrame([("USD",), ("EUR",), ("ZAR",), ("AED",)], "c string")
    packed = [r.c for r in codes.orderBy(money.packed(F.col("c"))).collect()]
    assert packed == ["AED", "EUR", "USD", "ZAR"]
    assert codes.where(money.unpacked(money.packed(F.col("c"))) != F.col("c")).count() == 0


def test_usd_never_assumes_a_rate(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('USD', 10BD, NULL), ('EUR', 10BD, 1.5BD), ('JPY', 10BD, NULL) v(currency, value, rate)"
    )
    got = {r.currency: r.usd for r in rows.select(
        "currency", money.to_usd(F.col("value"), F.col("currency"), F.col("rate").cast("decimal(24,10)")).alias("usd")
    ).collect()}
    assert got == {"USD": Decimal("10"), "EUR": Decimal("15"), "JPY": None}


VALUE = "cik string, namespace string, concept string, fact_unit string, unit string, val string, start date, " \
        "`end` date, accn string, fy int, fp string, form string, filed date, frame string"
DAY = datetime.date


def value(**changes):
    row = {
        "cik": "0000000001", "namespace": "us-gaap", "concept": "Assets", "fact_unit": None, "unit": "USD", "val": "5",
        "start": None, "end": DAY(2023, 12, 31), "accn": "0-1", "fy": 2022, "fp": "FY", "form": "10-K",
        "filed": DAY(2024, 2, 1), "frame": None,
    }
    return tuple((row | changes).values())


def normalized(spark, *rows):
    return normalize_facts(spark.createDataFrame(list(rows), VALUE))


def test_fiscal_year_follows_period_end(spark):
    got = normalized(
        spark, value(fy=2025, end=DAY(2026, 1, 31)), value(fy=2026, end=DAY(2026, 1, 31)), value(fy=2020, end=None),
        value(fy=None, end=None),
    )
    assert sorted(r.fiscal_year for r in got.collect()) == [2020, 2026, 2026]


def test_values_are_exact_or_left_out(spark):
    got = normalized(
        spark, value(val="1.0123456789"), value(val="12345678901234567890.5"), value(val="n/a"), value(val="1E3"),
        value(val="123456789012345678901234567890"),
    )
    assert {r.value for r in got.collect()} == {
        Decimal("1.0123456789"), Decimal("12345678901234567890.5"), Decimal(1000), None,
    }


def test_instant_and_source(spark):
    rows = normalized(
        spark, value(start=DAY(2023, 12, 31)), value(start=DAY(2023, 1, 1)), value(accn=None),
    ).orderBy("source_id").collect()
    assert [(r.source_id, r.period_start, r.is_instant) for r in rows] == [
        ("01|us-gaap:Assets|2023-01-01|2023-12-31", DAY(2023, 1, 1), False),
        ("01|us-gaap:Assets|2023-12-31|2023-12-31", None, True),
        ("us-gaap:Assets|2023-12-31", None, True),
    ]


def test_unit_falls_back(spark):
    got = normalized(spark, value(unit="EUR"), value(unit="", fact_unit="GBP"), value(unit=None))
    assert sorted(r.unit for r in got.collect()) == ["EUR", "GBP", "USD"]


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"concept": " "}, "concept is required"),
        ({"namespace": None}, "namespace is required"),
        ({"value": None}, "value is required"),
        ({"unit": ""}, "unit is required"),
        ({"period_end": None}, "period_end is required"),
        ({"fiscal_year": None}, "fiscal_year is required"),
        ({"fiscal_year": 1989}, "fiscal_year 1989 is outside valid range (1990-2030)"),
        ({"fiscal_year": 2031}, "fiscal_year 2031 is outside valid range (1990-2030)"),
        ({"fiscal_period": " "}, "fiscal_period is required"),
        ({"period_start": DAY(2024, 1, 1)}, "period_start must be <= period_end"),
        ({"is_instant": True}, "instant facts must have period_start = NULL"),
        ({"period_start": None}, "duration facts must have period_start != NULL"),
    ],
)
def test_each_rule(spark, change, message):
    row = {
        "concept": "Revenues", "namespace": "us-gaap", "value": Decimal(1), "unit": "USD", "period_start": DAY(2023, 1, 1),
        "period_end": DAY(2023, 12, 31), "fiscal_year": 2023, "fiscal_period": "FY", "is_instant": False,
    } | change
    types = "concept string, namespace string, value decimal(30,10), unit string, period_start date, period_end date, " \
            "fiscal_year int, fiscal_period string, is_instant boolean"
    valid, rejects = validate_facts(spark.createDataFrame([tuple(row.values())], types))
    assert valid.count() == 0
    assert rejects.first()["errors"] == [message]


def test_forms(spark):
    forms = spark.createDataFrame([("10-K",), ("10-Q/A",), ("8-K",), ("DEF 14A",), (None,)], "form string")
    assert {r.form for r in forms.where(facts.is_financial_form(F.col("form"))).collect()} == {"10-K", "10-Q/A", "8-K"}
